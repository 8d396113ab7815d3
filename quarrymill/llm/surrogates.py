"""Operator 5: personal data replaced by keyed surrogates. DataFrame functions only.

Entities: mail addresses, IPv4 and IPv6 addresses, card numbers, phone numbers, social security numbers, international bank
accounts, and names after a title. Each mention is reduced to a canonical value (digits of a number, a mail address in
lower case, each word of a name), and each distinct value gets a surrogate by SHA-256 of a secret key, its kind and
the value, so the same value has the same surrogate in every document (coreference). The surrogate keeps kind, script
and punctuation, and for all but names and mail addresses the length: it is written over the mention character by
character. Cards pass Luhn's test; bank accounts keep their country and have right check digits. A name's words come from
lists by script and by the gender its title shows (either after Dr. and the like); Cyrillic surnames take the form of that gender; words in
capitals stay in capitals. Where a surname was met after a title, its bare mentions in the same text are replaced too.

Collision checks: the table of distinct values is built with Spark; while two values of a kind share a surrogate, or a
surrogate equals a value that occurs, all but the least value take the next salt. So distinct values stay distinct.
Name words come from lists of bounded length; when all salts of the lists are taken, a numbered suffix of letters is added;
numbers whose format has no free values left get longer, every eighth round.

Defined cases: a null text stays null; an empty one stays empty. Ties and repeated rows are handled alike; null ids and
extra columns pass through, but for columns named like the two results, whose names are a parameter: these are replaced.
An empty table gives an empty result. Text outside entities is unchanged.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, release

# Fixed patterns, in order of preference where they meet.
MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+\-]*@[A-Za-z0-9][A-Za-z0-9\-]*(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
BANK = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
IP4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)"
CARD = r"(?<![\w])(?:\d{4}[ \-]?){3}\d{4}(?![\w])"
SSN = r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
IP6 = r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*\d)[0-9A-Fa-f]{2,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])"
PHONE = r"(?<![\w+])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}|\+\d{1,3} \d{2,4} \d{6,8}|0\d(?:[ .]\d{2}){4}|(?:\+7|8)[ \-]?\(?\d{3}\)?[ \-]\d{3}[ \-]\d{2}[ \-]\d{2})(?!\w)"
TITLES = {"f": "Mrs|Ms|Miss|Frau|Mme|Madame|Mlle|Sra|Señora|Doña|Госпожа", "m": "Mr|Sir|Herr|Monsieur|Sr|Señor|Don|Господин", "n": "Dr|Prof|Доктор|Профессор"}
NAME = r"\b(?:" + "|".join(TITLES.values()) + r")\.? \p{Lu}[\p{L}'\-]+(?: \p{Lu}[\p{L}'\-]+){0,2}"
ANY = "|".join(f"(?:{p})" for p in (MAIL, BANK, CARD, SSN, IP4, IP6, PHONE, NAME))
# Fixed surrogate names by script and gender.
FEMALE = ["Alma", "Berta", "Clara", "Dora", "Edith", "Flora", "Greta", "Hilda", "Irma", "Judith", "Klara", "Lotte", "Martha", "Nora", "Olga", "Paula"]
MALE = ["Albert", "Bruno", "Conrad", "David", "Erwin", "Felix", "Georg", "Hugo", "Ivan", "Julius", "Karl", "Ludwig", "Martin", "Norbert", "Otto", "Paul"]
SURNAMES = ["Abel", "Berg", "Carver", "Dorn", "Ebert", "Falk", "Garber", "Holm", "Imhof", "Jansen", "Keller", "Lang", "Moser", "Nolte", "Ortner", "Pohl"]
CYR_FEMALE = ["Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Лидия"]
CYR_MALE = ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев"]
CYR_SURNAMES = ["Белов", "Волков", "Громов", "Дубов", "Жуков", "Зимин", "Котов", "Лисин"]
DIGITAL = ("card", "ip", "ip6", "phone", "ssn", "bank")


def may_hold(text: Column) -> Column:
    """A quick test that every text with an entity passes: each pattern needs a digit, an @ or a title."""
    return F.coalesce(text.rlike("[0-9@]") | text.rlike(r"\b(?:" + "|".join(TITLES.values()) + r")\b"), F.lit(False))


def kind_of(mention: Column) -> Column:
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    return (
        F.when(mention.contains("@"), "mail").when(whole(BANK), "bank").when(whole(CARD), "card").when(whole(SSN), "ssn")
        .when(whole(IP4), "ip").when(whole(IP6), "ip6").when(whole(NAME), "name").otherwise("phone")
    )


def parts_of(mention: Column, kind: Column) -> Column:
    """The canonical (kind, value) pairs of a mention: one, or one for each word of a name."""
    female = mention.rlike(rf"^(?:{TITLES['f']})\b")
    words = F.slice(F.split(mention, " "), 2, 3)
    given = F.when(female, F.lit("female")).when(mention.rlike(rf"^(?:{TITLES['n']})\b"), F.lit("given")).otherwise(F.lit("male"))
    names = F.transform(words, lambda w, i: F.struct(F.when(i < F.size(words) - 1, given).otherwise(F.lit("surname")).alias("kind"), F.lower(w).alias("value")))
    value = F.when(kind.isin(*DIGITAL), F.upper(F.regexp_replace(mention, r"[^0-9A-Za-z]", ""))).otherwise(F.lower(mention))
    value = F.when(kind == "ip", mention).otherwise(value)
    return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"))))


def with_pieces(docs: DataFrame, text: str) -> DataFrame:
    """Adds __between (texts around the mentions) and __mentions, in order."""
    return docs.withColumn("__mentions", F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).withColumn("__between", F.split(text, ANY, -1))


def _digits(seed: Column, value: Column) -> Column:
    """value with each digit and letter replaced by one of its sort, drawn from seed."""
    draw = lambda i: F.conv(F.substring(F.sha2(F.concat(seed, F.lit(":"), (i / 16).cast("int").cast("string")), 256), (i % 16) * 4 + 1, 4), 16, 10).cast("int")
    return F.array_join(
        F.transform(
            F.split(value, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), F.char(draw(i) % 10 + 48)).when(c.rlike("[a-z]"), F.char(draw(i) % 26 + 97)).when(c.rlike("[A-Z]"), F.char(draw(i) % 26 + 65)).otherwise(c),
        ), "",
    )


def _card(digits: Column) -> Column:
    """digits with a last one that passes Luhn's test."""
    n = F.length(digits)
    doubled = lambda c, i: F.when((n - i) % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(F.split(F.substring(digits, F.lit(1), n - 1), ""), doubled), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(digits, F.lit(1), n - 1), ((10 - total % 10) % 10).cast("string"))


def _account(value: Column, drawn: Column) -> Column:
    """drawn with the country of value and the check digits of both (ISO 13616)."""
    country, rest = F.substring(value, 1, 2), F.substring(drawn, 5, 40)
    step = lambda a, c: (F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97).cast("int")
    left = F.aggregate(F.split(F.concat(rest, country, F.lit("00")), ""), F.lit(0), step)
    return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), rest)


def surrogate_of(secret: str, kind: Column, value: Column, salt: Column) -> Column:
    seed = F.sha2(F.concat_ws("\u0000", F.lit(secret), kind, value, salt.cast("string")), 256)
    number = F.conv(F.substring(seed, 1, 8), 16, 10).cast("long")
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    # beyond the list, letters that say which round of it this is
    pick = lambda names: F.concat(F.element_at(F.array(*[F.lit(n) for n in names]), ((number + salt) % len(names)).cast("int") + 1), F.when(salt > 0, F.translate(F.hex(salt + (number % 65536) * 16), "0123456789ABCDEF", "abcdefghijklmnop")).otherwise(F.lit("")))
    octet = lambda k: (F.conv(F.substring(seed, 4 * k + 1, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    local = _digits(seed, F.substring_index(value, "@", 1))
    drawn = _digits(seed, F.concat(value, F.repeat(F.lit("0"), F.floor(salt / 8).cast("int"))))
    host = F.concat(F.substring(F.translate(seed, "0123456789", "ghijklmnop"), 1, 10), F.lit(".example"))
    return (
        F.when(kind == "mail", F.concat(local, F.lit("@"), host))
        .when(kind == "ip", F.concat_ws(".", F.lit("10"), octet(0), octet(1), octet(2)))
        .when(kind == "female", F.when(cyrillic, pick(CYR_FEMALE)).otherwise(pick(FEMALE)))
        .when(kind == "male", F.when(cyrillic, pick(CYR_MALE)).otherwise(pick(MALE)))
        .when(kind == "surname", F.when(cyrillic, pick(CYR_SURNAMES)).otherwise(pick(SURNAMES)))
        .when(kind == "given", F.when(cyrillic, pick(CYR_FEMALE + CYR_MALE)).otherwise(pick(FEMALE + MALE)))
        .when(kind == "ip6", F.concat(F.lit("fd"), F.substring(seed, F.lit(3), F.length(F.regexp_replace(value, "[^0-9A-Fa-f]", "")) - 2)))
        .when(kind == "card", _card(drawn)).when(kind == "bank", _account(value, drawn)).otherwise(drawn)
    )


def assign_surrogates(values: DataFrame, secret: str) -> DataFrame:
    """kind, value, surrogate of distinct values; distinct within each kind and unequal to every value."""
    done = materialize(values.select("kind", "value", F.lit(0).cast("long").alias("salt"), surrogate_of(secret, F.col("kind"), F.col("value"), F.lit(0).cast("long")).alias("surrogate")), "surrogates")
    for turn in itertools.count(1):
        least = done.groupBy("kind", "surrogate").agg(F.min("value").alias("owner"), F.count("*").alias("c"))
        taken = done.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("taken"))
        clash = least.join(taken, ["kind", "surrogate"], "left").where("c > 1 or taken")
        clash = materialize(clash.select("kind", "surrogate", F.when(F.col("taken"), F.lit(None)).otherwise(F.col("owner")).alias("owner")), "clashes")
        if not clash.count():
            return done
        rows = done.join(clash.withColumn("hit", F.lit(True)), ["kind", "surrogate"], "left")
        again = F.col("hit").isNotNull() & (F.col("owner").isNull() | (F.col("owner") != F.col("value")))
        salt = F.when(again, F.lit(turn).cast("long")).otherwise(F.col("salt"))
        rows = rows.withColumn("salt", salt).withColumn("surrogate", F.when(again, surrogate_of(secret, F.col("kind"), F.col("value"), F.col("salt"))).otherwise(F.col("surrogate")))
        done = materialize(rows.select("kind", "value", "salt", "surrogate"), "surrogates")


def named(surrogate: Column, word: Column, mention: Column, surname: Column) -> Column:
    """A name's word in the form of the one it replaces: capitals, and the feminine of a Cyrillic surname after such a title."""
    feminine = surname & mention.rlike(rf"^(?:{TITLES['f']})\b") & surrogate.rlike(r"\p{IsCyrillic}$")
    formed = F.when(feminine, F.concat(surrogate, F.lit("а"))).otherwise(surrogate)
    return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(formed)).otherwise(formed)


def rendered(mention: Column, kind: Column, found: Column) -> Column:
    """The surrogate in the mention's format; found are the surrogates of its parts, in order."""
    first = F.element_at(found, 1)
    # digits and letters of the surrogate, one by one over those of the mention
    format_ = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(F.concat(a["out"], F.substring(first, a["at"], 1)).alias("out"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))),
        lambda a: F.concat(a["out"], F.coalesce(F.substring(first, a["at"], F.length(first)), F.lit(""))),
    )
    words = F.split(mention, " ")
    said = F.transform(found, lambda f, i: named(f, F.get(words, i + 1), mention, i == F.size(found) - 1))
    return (
        F.when(kind == "mail", F.when(mention == F.upper(mention), F.upper(first)).otherwise(first))
        .when(kind == "ip", first)
        .when(kind == "name", F.concat_ws(" ", F.get(words, F.lit(0)), F.array_join(said, " ")))
        .otherwise(format_)
    )


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("n_entities", "kinds")) -> DataFrame:
    """docs with surrogates in text, and, named by counts, the number of entities (long) and the sorted array of their kinds."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in counts}])
    row, new_text = free_name(docs, "row"), free_name(docs, "new_text")
    body = docs.select(F.col(f"`{text}`").alias("t"))
    pieces = with_pieces(body.where(may_hold(F.col("t"))), "t").where(F.size("__mentions") > 0).select(F.xxhash64("t").alias("__row"), "__mentions", "__between")
    pieces = materialize(pieces.dropDuplicates(["__row"]), "pieces")
    mentions = pieces.select("__row", F.posexplode("__mentions").alias("__at", "mention")).withColumn("kind", kind_of(F.col("mention")))
    parts = mentions.select("__row", "__at", "mention", "kind", F.posexplode(parts_of(F.col("mention"), F.col("kind"))).alias("part", "p"))
    parts = materialize(parts.select("__row", "__at", "mention", F.col("kind").alias("whole"), "part", "p.kind", "p.value"), "parts")
    table = assign_surrogates(parts.select("kind", "value").distinct(), secret)
    found = parts.join(table, ["kind", "value"]).groupBy("__row", "__at", "mention", "whole").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "surrogate"))), lambda x: x["surrogate"]).alias("found")
    )
    written = found.select("__row", "__at", "whole", rendered(F.col("mention"), F.col("whole"), F.col("found")).alias("new"), F.when(F.col("whole") == "name", F.struct(F.substring_index("mention", " ", -1).alias("k"), F.substring_index(rendered(F.col("mention"), F.col("whole"), F.col("found")), " ", -1).alias("v"))).alias("surname"))
    by_row = written.groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("__at", "new"))).alias("__new"), F.array_sort(F.collect_set("whole")).alias("kinds"), F.array_sort(F.collect_set("surname")).alias("surnames")
    )
    # a surname that stood after a title is the same person's where it stands alone
    first = F.filter("surnames", lambda x, i: (i == 0) | (F.get("surnames", i - 1)["k"] != x["k"]))
    known = F.map_from_entries(first)
    bare = lambda t: F.array_join(F.transform(F.regexp_extract_all(t, F.lit(r"\p{L}[\p{L}'\-]*|[^\p{L}]+"), F.lit(0)), lambda w: F.coalesce(F.try_element_at("known", w), w)), "")
    joined = by_row.withColumn("known", known).join(pieces.select("__row", "__between"), "__row")
    between = F.when(F.size("surnames") > 0, F.transform("__between", bare)).otherwise(F.col("__between"))
    texts = joined.withColumn("__between", between).select(
        F.col("__row").alias(row), F.col("kinds").alias(counts[1]), F.size("__new").cast("long").alias(counts[0]),
        F.array_join(F.flatten(F.zip_with("__between", F.transform("__new", lambda x: x["new"]), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "").alias(new_text),
    )
    texts = materialize(texts, "texts")
    release(pieces, parts)
    # documents without entities never move; of the others only the new texts and the other columns do
    has = may_hold(F.col(text)) & F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    plain = docs.where(~has).withColumn(counts[0], F.lit(0).cast("long")).withColumn(counts[1], F.array().cast("array<string>"))
    hit = docs.where(has).withColumn(row, F.xxhash64(text)).drop(text).join(texts, row).withColumnRenamed(new_text, text)
    columns = [*docs.columns, *counts]
    return plain.select(columns).unionByName(hit.select(columns))
