"""Operators 11 to 13: brute force, planted ties and nulls, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarrymill.llm import conversation_trie, filter_audit, fingerprints, surrogates  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string, depth int, shard string"
EMPTY = hashlib.sha256(b"").hexdigest()


def trie_by_hand(rows):
    """The contract, literally."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for c in convs.values():
        c.sort(key=lambda t: t[:2])
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        new[c] = tuple(t[2:] for t in [*convs.get(c - c % 100, [])[:h], *own[h:]])
    members = collections.defaultdict(list)
    for c, s in new.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += not kids[k]
    ends = lambda k, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(new[c]) == len(k)).encode()).hexdigest()
    return sorted([(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends(k, m)) for k, m in members.items()], key=repr)


def trie(spark, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        df = spark.createDataFrame([(*r, 7, "x") for r in rows], TURNS)
        got = conversation_trie.shared_opening_trie(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return sorted([tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in got], key=repr)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_trie_against_brute_force(spark, shards):
    """A hot conversation that spans shards, prefixes of others, long ones, nulls, turnless and repeated ones."""
    rows = [(c, t, "user", f"{t}") for c in range(100, 160) for t in range(9)]  # copies
    rows += [(c, t, "user", f"{t}") for c in range(200, 230) for t in range(c % 9)]  # their prefixes
    rows += [(c, t, "user" if t % 2 else None, f"say {c % 3 if t > 3 else 0}" * (t % 4)) for c in range(300, 340) for t in range(8)]
    rows += [(5, t, "a", f"long {min(t, 150)}") for t in range(200)] + [(6, t, "a", f"long {min(t, 140)}") for t in range(200)]
    rows += [(401, None, None, None), (401, 1, "user", None), (402, 3, "", ""), (None, 1, "user", "lost"), (999_999, 0, "user", "one"), (403, 0, "user", "日本語 😀")]
    assert trie(spark, rows, shards) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert trie(spark, [], 4) == []
    h0 = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)  # its own turn goes, and there is no base
    assert trie(spark, [(h0, 0, "user", "gone")], 4) == [(h0, 0, None, 1, 0, 1, 0, hashlib.sha256(str(h0).encode()).hexdigest())]


def test_trie_ties_have_one_result(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 2, "user", "c")]
    assert trie(spark, rows, 3) == trie(spark, rows[::-1], 5)


def items_by_hand(text):
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    word = lambda t, seed=42: xxhash.xxh64(t.encode(), seed=seed & (2**64 - 1)).intdigest()
    number = lambda x, seed=42: xxhash.xxh64((x & (2**64 - 1)).to_bytes(8, "little"), seed=seed).intdigest()
    import regex

    tokens = regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|[^ \t\n\v\f\r\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]{1,16}", text)
    out, before = [], -1
    if len(tokens) >= 5:
        g = [signed(word(b, word(a))) for a, b in itertools.pairwise(tokens)]
        for i in range(len(tokens) - 4):
            if min(g[i], g[i + 3]) <= min(g[i + 1], g[i + 2]):
                out.append(min(i - before, 255) << 32 | number(g[i + 3], number(g[i + 2], number(g[i]))) & 0xFFFFFFFF)
                before = i
    if len(tokens) < 20:
        out += [word(t) & 0xFFFFFFFF for t in tokens]
    return out


def test_fingerprints_against_brute_force(spark):
    """Whole texts of the smallest documents, with nulls, empty, short, long and unspaced texts, repeated keys and rows."""
    base = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    odd = [(None, "no key here at all, none"), (None, None), (900, ""), (901, "a"), (902, "x" * 500), (903, "水が流れる川の音を聞く" * 5), (904, "word " * 3000), (905, "word " * 3000), (905, "second row of a key"), (905, "word " * 3000), (906, "😀 é\tß\n" * 9)]
    df = spark.createDataFrame([(*r, "x", "y") for r in base + odd], "doc_id long, text string, items string, edited string")
    rows = fingerprints.fingerprints(df.repartition(5)).collect()
    order = sorted(base + odd, key=lambda r: (r[0] is not None, r[0] or 0))
    written = lambda t: "".join(f"{x:010x}" for x in items_by_hand(t))
    like = lambda a, b: 1.0 if not a and not b else 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b)))
    got = collections.Counter((r["doc_id"], r["n_chars"], r["fingerprint"]) for r in rows)
    assert got == collections.Counter((k, len(t or ""), written(t or "")) for k, t in order)
    clear = {r["doc_id"]: r for r in rows if r["doc_id"] is not None and r["doc_id"] not in (904, 905)}
    for (k, t), (_, after) in itertools.pairwise([r for r in order if r[0] is not None]):
        if k in clear:
            t, after = t or "", after or ""
            edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
            r = clear[k]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["edited_fingerprint"] == written(edited)
            assert abs(r["near_edited"] - like(items_by_hand(t), items_by_hand(edited))) < 1e-12
            if k != 903:  # the next key has several texts
                assert abs(r["near_next"] - like(items_by_hand(t), items_by_hand(after))) < 1e-12
    # the last row takes from the first
    first = next(t or "" for k, t in sorted(odd, key=lambda r: r[0] is not None) if k is None)
    ends = {hashlib.sha256((odd[-1][1][: 54 - 13] + (t or "")[:13]).encode()).hexdigest() for t in (first, "", "no key here at all, none")}
    assert clear[906]["edited_sha256"] in ends


def test_fingerprint_blocks(spark):
    """Many blocks give what one gives; a lone row follows itself; no rows, no result."""
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3001).alias("doc_id"), F.concat_ws(" ", *[F.sha2((F.col("id") + i).cast("string"), 256) for i in range(4)]).alias("text"))
    got = fingerprints.fingerprints(df).toPandas().set_index("doc_id")
    text = df.toPandas().set_index("doc_id").text.sort_index()
    after = dict(zip(text.index, [*text.index[1:], text.index[0]], strict=True))
    for k, t in text.items():
        cut = len(t) // 4
        assert got.edited_sha256[k] == hashlib.sha256((t[: len(t) - cut] + text[after[k]][:cut]).encode()).hexdigest()
    one = fingerprints.fingerprints(spark.createDataFrame([("k", "one two three four five six")], "doc_id string, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"one two three four five one tw"[:21] + b"one tw").hexdigest()
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lattice():
    edges = filter_audit.lattice("ABCDE")
    assert len(edges) == 80 and all(sum(n for _, f, _, n in edges if f == g) == 120 for g in range(5))
    assert {n for s, _, _, n in edges if s == 0} == {24} and {n for s, _, _, n in edges if s.bit_count() == 2} == {4}


def test_audit_against_brute_force(spark):
    """Every order applied in turn, with null and repeated keys, null parts and texts, several labels."""
    long = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", "a b a b a b", long, long + " $", long.upper(), long, "x " * 400, long + "|A", "a b \x0b c", long]
    docs = [(i % 23 if i % 7 else None, t, ["s", "t", None][i % 3], "n") for i, t in enumerate(texts * 4)] + [(3, long, "s", "n"), (3, long, "s", "n")]
    labels = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(4, 1, 1), (None, 1, 1), (5, None, None)]
    got = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, source string, mask string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    good, bad = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}

    def fails(d, t):
        t = t or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
        first = min((k for k, x, *_ in docs if (x or "") == t and k is not None), default=None)
        return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t), d is not None and first < d]

    want, sums = {}, collections.Counter()
    rows = [(part or "", d, fails(d, t)) for d, t, part, _ in docs]
    for part in {r[0] for r in rows}:
        for order in itertools.permutations(range(5)):
            left = [r for r in rows if r[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                out = [r for r in left if r[2][f]]
                gone = len([r for r in everyone if r[2][f]]) - len(out)
                left = [r for r in left if not r[2][f]]
                want[part, "".join("ABCDE"[i] for i in order), step] = (len(left), len(out), gone, sum(sum(r[2]) == 1 and r[2][f] for r in everyone), sum(r[1] in good for r in out), sum(r[1] in bad for r in out))
                sums[part, f] += len(out)
    assert len(got) == len(want) == 3 * 600
    for r in got:
        at = (r["part"], r["filter_order"], r["step"])
        assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"]) == want[at]
        assert r["shapley"] == sums[r["part"], "ABCDE".index(r["filter_order"][r["step"] - 1])]


def test_audit_of_nothing(spark):
    none, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0
    assert filter_audit.audit(spark.createDataFrame([(1, "a", "s")], none.schema), labels).count() == 600


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates_keep_form(spark):
    """Case, gender, script, check digits; a later bare surname; formats of telephones; columns named like the results or the operator's own."""
    texts = [
        "Mrs SMITH met Mr John Smith. Smith left Smithville.", "Госпожа Анна Белова и Белова", "DE89 3704 0044 0532 0130 00 paid, GB82WEST12345698765432 too", "card 4111-1111-1111-1111.",
        "Señora María García López came; López", "Dr. John Doe and Doe", "01 23 45 67 89 or +49 170 1234567 or 2001:db8::1 or 8 (912) 345-67-89", "at 12:30:45 on 2024-01-02, a::b, 3 of 10",
    ]
    df = spark.createDataFrame([(i, t, "mine", 1, 2, 3) for i, t in enumerate(texts)], "doc_id int, text string, kinds string, n_entities int, __row int, __text int")
    rows = {r["doc_id"]: r for r in surrogates.replace_entities(df, "k").collect()}
    got = {i: r["text"] for i, r in rows.items()}
    a = got[0].split()
    assert a[1] == a[1].upper() and a[1].lower() == a[5].rstrip(".").lower() == a[6].lower() and a[8] == "Smithville." and "Smith " not in got[0]
    b = got[1].split()
    assert b[2] == b[4] and b[2].endswith("а") and b[1] in surrogates.CYR_FEMALE and rows[1]["__row"] == 2
    for account in __import__("re").findall(r"[A-Z]{2}\d{2}[A-Z0-9 ]+(?= paid| too)", got[2]):
        plain = account.replace(" ", "")
        assert plain[:2] in ("DE", "GB") and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert luhn(got[3]) and got[3][9] == "-" and got[3] != texts[3]
    assert got[4].split()[-1] == got[4].split()[3] and not {"María", "García", "López"} & set(got[4].replace(";", "").split())
    assert "Doe" not in got[5] and got[5].split()[2] == got[5].split()[4]
    assert rows[6]["n_entities"] == 4 and got[6].count("or") == 3 and not [n for n in ("23 45", "170", "db8", "912") if n in got[6]]
    assert got[7] == texts[7] and rows[7]["kinds"] == []


def test_surrogates_stay_distinct(spark):
    """On the driver's documents: as many surrogates as values of a kind, none of them a value; short numbers that use up their format."""
    import collections as c

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = surrogates.with_pieces(docs, "text").select(F.explode("__mentions").alias("m"))
    values = pieces.select(F.explode(surrogates.parts_of(F.col("m"), surrogates.kind_of(F.col("m")))).alias("p")).select("p.*").distinct()
    full = spark.range(100).select(F.lit("phone").alias("kind"), F.lpad(F.col("id").cast("string"), 2, "0").alias("value"))
    for table in (values, full):
        rows = surrogates.assign_surrogates(table, "k").collect()
        assert len(rows) == table.count() and len({(r["kind"], r["surrogate"]) for r in rows}) == len(rows)
        known = {(r["kind"], r["value"]) for r in rows}
        assert not known & {(r["kind"], r["surrogate"]) for r in rows} and c.Counter(r["kind"] for r in rows)
