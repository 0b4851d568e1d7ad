"""Byte-level BPE, filter audit and fill-in-middle against the library, plain loops and SQL."""

import base64
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from eventloom.llm import bpe, fill_middle, filter_audit
from eventloom.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=VOCABULARY[1], mergeable_ranks=ranks, special_tokens={})


def _sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- op11 ----------------------------------------------------------------------------------------------------------

ODD = ["", " ", "\n\n  x", "a" * 5000, "ab" * 3000, "I'll'd  we've  x", "<|endoftext|>", "éé\U0001f600\U0001f468‍\U0001f469", "12345 67²Ⅷ", "x" * 47 + "\t" + "y" * 49, "\x00\x1c\x85\r\n", "中文" * 700]


def _ids(codec, text, raw=False):
    (ids,) = codec.encode([text])
    return ids if raw else np.frombuffer(ids, np.int32).tolist()


def test_forest_is_the_tree():
    """Rows of one array merge as trees of their own do, whatever their lengths and the vocabulary."""
    rng = random.Random(15)
    ranks = {bytes([b]): b for b in range(256)}
    for k in range(300):
        ranks.setdefault(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))), 256 + k)
    forest = bpe.MergeForest(ranks)
    for width in (1, 2, 4, 8, 16, 32):
        matches = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(width // 2 + 1, width + 1))) for _ in range(200)]
        for match, ids in zip(matches, forest.merged(matches, width), strict=True):
            tree = bpe.MergeTree(match, ranks)
            tree.merge_all()
            assert np.frombuffer(ids, np.int32).tolist() == [ranks[p] for p in tree.parts()]
    assert bpe.MergeForest({bytes([b]): b for b in range(256)}).merged([b"ab"], 2) == [np.array([97, 98], np.int32).tobytes()]


def test_merge_tree_is_the_library(library):
    rng = random.Random(11)
    codec = bpe.Codec(*VOCABULARY)
    texts = ODD + ["".join(rng.choice("abcde ' \né中\U0001f600,.1") for _ in range(rng.randrange(200))) for _ in range(400)]
    for t, ids in zip(texts + texts, codec.encode(texts) + [_ids(codec, t, raw=True) for t in texts]):
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == library.encode_ordinary(t), t[:50]
        assert codec.decode(ids) == t.encode()
    # a longer match in n log n steps, and bytes that are no text
    data = bytes(rng.randrange(97, 123) for _ in range(60_000))
    assert _ids(codec, data.decode()) == library.encode_ordinary(data.decode())
    tree = bpe.MergeTree(b"\xff\xfe" * 9, codec.ranks)
    tree.merge_all()
    assert b"".join(tree.parts()) == b"\xff\xfe" * 9 and all(p in codec.ranks for p in tree.parts())


def test_merge_tree_takes_the_leftmost_of_equal_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"aab": 301}
    for n in range(1, 30):
        tree = bpe.MergeTree(b"a" * n + b"b", ranks)
        tree.merge_all()
        parts = [b"aa"] * (n // 2) + ([b"a"] if n % 2 else []) + [b"b"]
        if n % 2 == 0:
            parts[-2:] = [b"aab"]
        assert tree.parts() == parts


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_MATCHES", 3)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 4)
    codec = bpe.Codec(*VOCABULARY)
    for t in ("zqx wvutsr lmnopqrst zqx", "ab zqx", "one two three four five six seven", "zqx zqx", "abcdefghijk xyzxyz abcdefghijk"):
        assert _ids(codec, t) == library.encode_ordinary(t)
        assert len(codec.known) <= 3


def test_op11_is_the_library(spark, sf, library):
    got = {r["doc_id"]: r for r in bpe.op11_byte_bpe(spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d["text"] or ""), got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), _sha(" ".join(map(str, ids))), _sha(d["text"] or ""))


def test_bpe_odd_rows(spark, library, tmp_path):
    rows = [(k, t, "other", b"y") for k, t in enumerate([*ODD, None, ODD[3], None])]
    frame = spark.createDataFrame(rows, "id long, text string, ids string, decoded binary")
    encoded = bpe.encode_texts(frame.withColumn("ids_", F.col("ids")), *VOCABULARY)
    assert encoded.columns == ["id", "decoded", "ids_", "ids"]
    back = bpe.decode_ids(encoded, *VOCABULARY).collect()
    for (k, t, *_), r in zip(rows, sorted(back), strict=True):
        assert r["id"] == k and r["ids"] == library.encode_ordinary(t or "") and bytes(r["decoded"]) == (t or "").encode() and r["ids_"] == "other"
    assert bpe.decode_ids(bpe.encode_texts(frame.limit(0), *VOCABULARY), *VOCABULARY).count() == 0
    cut = encoded.filter("id = 7").select("id", F.slice("ids", 1, 1).alias("ids")).unionByName(spark.sql("select 1L as id, cast(null as array<int>) as ids"))
    (a, b) = sorted(bpe.decode_ids(cut, *VOCABULARY).collect())
    assert a["decoded"] is None and ODD[7].encode().startswith(bytes(b["decoded"]))
    with pytest.raises(Exception, match="IndexError"):
        bpe.decode_ids(spark.sql("select array(-1) as ids"), *VOCABULARY).collect()
    (tmp_path / "ranks").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="without a rank"):
        bpe.read_ranks(str(tmp_path / "ranks"))


# --- op12 ----------------------------------------------------------------------------------------------------------


def _duck(sf, *names):
    con = duckdb.connect()
    for n in names:
        con.sql(f"create view {n} as select * from read_parquet('{sf}/{n}.parquet')")
    return con


def _audit_brute(docs, labels):
    """Order by order and document by document."""
    good = {d for d, q, t in labels if q == 1 and d is not None}
    toxic = {d for d, q, t in labels if t == 1 and d is not None}
    key = lambda i: (i is not None, i if i is not None else 0)
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", key(i)), key(i))
    fails = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        f = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        fails.append((i, part or "", f + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (least[t] < key(i))))
    out, shapley = {}, {}
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for _, p, _ in fails}:
            left = [(i, f) for i, p, f in fails if p == part]
            gone = []
            for step, x in enumerate(order, 1):
                hit = [i for i, f in left if x in f]
                redundant = sum(x in f for f in gone)
                gone += [f for _, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[part, x] = shapley.get((part, x), 0) + len(hit)
                unique = sum(p == part and f == x for _, p, f in fails)
                out[part, order, step] = [len(left), len(hit), redundant, unique, sum(i in good for i in hit), sum(i in toxic for i in hit)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_op12_is_its_sql(spark, sf):
    frame = filter_audit.op12_filter_audit(spark, sf)
    order = ", ".join(frame.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(_duck(sf, "documents", "labels").sql(f"select {order} from ({filter_audit.ORACLE})").fetchall())


@pytest.mark.parametrize("broadcast_ids", [0, 1_000_000])
@pytest.mark.parametrize("ids", ["long", "string"])
def test_audit_brute(spark, broadcast_ids, ids):
    rng = random.Random(12)
    base = ["x " * 60, " ".join(f"w{k}" for k in range(80)), "A" * 700, "", None, "é" * 300, "e" * 300, "e" * 299 + "f", " ".join(f"W{k} #" for k in range(200)), "long " * 5000, "long " * 4999 + "lonk "]
    docs = [(k, rng.choice(base), rng.choice(["a", "b", None, ""])) for k in range(150)]
    docs += [docs[3], docs[3], (None, base[0], "a"), (None, base[1], "b"), (7, base[2], "a")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 150, 2)] + [(4, 1, 0), (None, 1, 1)]
    cast = (lambda i: i) if ids == "long" else (lambda i: None if i is None else f"d{i:04}")
    docs, labels = [(cast(i), t, p) for i, t, p in docs], [(cast(i), q, t) for i, q, t in labels]
    frame = spark.createDataFrame([(*d, 1, "z") for d in docs], f"doc_id {ids}, text string, source string, mask int, class string")
    marks = spark.createDataFrame(labels, f"doc_id {ids}, quality int, toxic int")
    got = filter_audit.audit(filter_audit.mask_counts(frame, marks, broadcast_ids=broadcast_ids))
    expected = _audit_brute(docs, labels)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in FIGURES) for r in got.collect()} == expected
    assert got.count() == len(expected) == 3 * 600


def test_audit_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.mask_counts(docs, labels)).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    rows = filter_audit.audit(filter_audit.mask_counts(one, labels)).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""} and sum(r["removed"] for r in rows) == 120 and {r["good_lost"] for r in rows} == {0}


def test_refinement_drops_what_is_alone(spark):
    """Each split drops singletons, whatever split them; equal texts stay together."""
    rows = [(1, 5, [1, 2]), (2, 5, [1, 2]), (3, 5, [1, 3]), (4, 5, [9]), (5, 6, [1, 2]), (6, 7, []), (7, 7, []), (8, 7, [4])]
    left = filter_audit.refine(spark.createDataFrame(rows, "id long, length int, blocks array<long>")).collect()
    assert {r["id"] for r in left} == {1, 2, 6, 7} and len({r["class"] for r in left}) == 2


# --- op13 ----------------------------------------------------------------------------------------------------------


def test_unit_bits_brute():
    rng = random.Random(13)
    for _ in range(300):
        text = "".join(rng.choice("aZ bé中\U0001f600\n1<") for _ in range(rng.randrange(90)))
        data = text.encode()
        units = [len(text[: m.start()].encode()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        bits = fill_middle.unit_starts(data)
        assert [k for k in range(len(data)) if bits >> k & 1] == units and bits.bit_count() == len(units)
        assert [fill_middle.ranked_bit(bits, len(data), k) for k in range(len(units) + 1)] == [*units, len(data)]


def _fim_brute(id, text):
    h = [int(_sha(f"1:{'' if id is None else id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_brute_and_back(spark):
    rng = random.Random(14)
    texts = ["", None, "<P>", "a<S>b", "<", ">", "<<P", "P>M>", "a" * 300_000, "\U0001f600" * 9, "\x00\n\r"] + ["".join(rng.choice("ab <>PSMé\U0001f600\n") for _ in range(rng.randrange(60))) for _ in range(200)]
    rows = [(k, t, "h", -1) for k, t in enumerate(texts)] + [(None, "one two three", "h", -1), (5, "one two three", "h", -1), (5, "one two three", "h", -1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fim_h0 string, fim_n int")
    out = fill_middle.fill_in_middle(frame).withColumn("back", fill_middle.restored_text(F.col("fim_text"), F.col("fim_form")))
    assert out.columns == ["doc_id", "fim_h0", *fill_middle.MADE, "back"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted([(r["doc_id"], r["back"], *[r[c] for c in fill_middle.MADE], r["fim_h0"]) for r in out.collect()], key=key)
    assert got == sorted([(i, t or "", *_fim_brute(i, t or ""), "h") for i, t, *_ in rows], key=key)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_fim_parameters(spark):
    docs = spark.createDataFrame([(f"k{k}", "alpha beta, gamma") for k in range(300)], "doc_id string, text string")
    rates, markers = fill_middle.Rates(100, 50), fill_middle.Markers("[pre]", "[suf]", "[mid]")
    out = fill_middle.fill_in_middle(docs, seed=2, markers=markers, rates=rates)
    forms = {r["fim_form"]: r["count"] for r in out.groupBy("fim_form").count().collect()}
    assert set(forms) == {"psm", "spm"} and 100 < forms["spm"] < 200
    assert out.filter(fill_middle.restored_text(F.col("fim_text"), F.col("fim_form"), markers) == "alpha beta, gamma").count() == 300
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "P>x", "<M>"), ("", "a", "b"), ("<P>", "<P>x", "<M>"), ("aba", "c", "d")):
        with pytest.raises(ValueError, match="markers"):
            fill_middle.Markers(*bad)


def test_op13_is_its_sql(spark, sf):
    frame = fill_middle.op13_fill_in_middle(spark, sf)
    order = ", ".join(frame.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(_duck(sf, "documents").sql(f"select {order} from ({fill_middle.ORACLE})").fetchall())
