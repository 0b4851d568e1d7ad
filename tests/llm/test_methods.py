"""The methods themselves against plain loops: templates, token tables, shards, repeats, the label model."""

import math
import os
import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from eventloom.llm import common, decontaminate, html_text, quality, simhash, tokens, warc
from eventloom.llm.common import scratch_path, table


def _words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def _repeats(text):
    words, where = _words(text), {}
    for k in range(len(words) - 2):
        where.setdefault(tuple(words[k : k + 3]), []).append(k)
    return len({k + j for v in where.values() if len(v) > 1 for k in v for j in range(3)})


# --- op3 -----------------------------------------------------------------------------------------------------------


def test_html_counts_brute(spark):
    """The templates that Spark counts are those of a plain loop over the pages."""
    rng = random.Random(9)
    menus = [f"<ul><li><a href='/{m}'>menu {m}</a></li><li><a href='/x'>all {m}</a></li></ul>" for m in range(6)]
    rows = []
    for k in range(60):
        body = "".join(f"<p>{' '.join(f'w{rng.randrange(9999)}' for _ in range(30))}</p>" for _ in range(3))
        rows.append((k, f"http://h{k % 3}/{k}", f"<div>{menus[k // 3 % 4]}</div><div>{body}<p>Share this</p></div><div>by {'abc'[k // 3 % 3]} of the site</div>"))
    pages, stands = {}, {}
    for _, url, html in rows:
        root, host = html_text.parse(html), html_text.host_of(url)
        nodes = html_text.hash_subtrees(root, host)
        (top,) = html_text.article_roots(root)
        article = "\n".join(html_text._read(top, True, lambda _: False, False))
        pages.setdefault(host, set()).add(article)
        for n in html_text._candidates(nodes):
            stands.setdefault((host, n.key(), n.inside), set()).add(article)
    expected = set()
    for (host, h, inside), on in stands.items():
        n = len(pages[host])
        if len(on) >= max(3, n / 2) or (not inside and len(on) >= max(2, math.floor(0.2 * n**0.5))):
            expected.add(h)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["h"] for r in html_text.recurring_subtrees(frame, 10).collect()} == expected and len(expected) > 20
    for r in html_text.main_text(frame).collect():
        assert "menu" not in r["text"] and "Share" not in r["text"] and "site" not in r["text"] and r["text"].count("\n") == 2


def test_html_without_markup(spark, sf):
    """Names, classes and roles taken off, the articles' lines stay and what recurs on the host goes."""
    real = table(spark, sf, "pages").filter("html is not null")
    bare = F.regexp_replace(F.regexp_replace("html", r"<(/?)(article|main|nav|footer|aside|header)\b[^>]*>", "<$1div>"), r' (class|id|role)="[^"]*"', "")
    # each page again with other words in its article: menus and footers recur
    twice = real.withColumn("html", bare).select("page_id", "url", "html")
    more = twice.select((F.col("page_id") + 10**6).alias("page_id"), "url", F.regexp_replace("html", "<h1>", "<h1>Other words to begin with: ").alias("html"))
    own = {r["page_id"]: r["text"].split("\n") for r in html_text.main_text(real).collect()}
    got = {r["page_id"]: r["text"] for r in html_text.main_text(twice.union(more)).collect()}
    for k, blocks in own.items():
        assert set(blocks) <= set(got[k].split("\n"))
    assert sum("©" in got[k] for k in own) <= 0.1 * len(own)


def test_html_edges(spark):
    """Empty table, clashing columns, deep nesting, a very long page, several main parts, and what markup declares."""
    kind = "page_id long, url string, html string, h long, text string"
    assert html_text.main_text(spark.createDataFrame([], kind)).count() == 0
    rows = [
        (1, "http://a/", "<div>" * 3000 + "deep" + "</div>" * 3000, 1, "x"), (2, "http://b/", "<article><p>" + "long words " * 200_000 + "</p></article>", 2, None),
        (3, "http://c/", "<main><p>own</p><article><p>in</p></article></main><p>out</p><main><p>second</p></main>", 3, "y"),
        (4, "http://d/", "<div class='content has-sidebar'><h1>T</h1><p>a</p></div>", 4, "y"), (5, "http://e/", "<div class='entry no-comments'><p>b</p></div>", 5, "y"),
        (6, "http://f/", "<article><div class='notice'>n</div><p class='related'>kept</p></article>", 6, "y"),
    ]
    got = {r["page_id"]: r for r in html_text.main_text(spark.createDataFrame(rows, kind)).collect()}
    assert got[1]["text"] == "deep" and got[2]["n_chars"] == 200_000 * 11 - 1
    assert [got[k]["text"] for k in (3, 4, 5, 6)] == ["own\nin\nsecond", "T\na", "b", "kept"]


# --- op2 -----------------------------------------------------------------------------------------------------------


def test_token_query_as_the_library(spark, sf):
    """The query over all documents, and prefixes of words of many alphabets."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs = Tokenizer.from_file(path)
    n = lambda t: len(theirs.encode(t, add_special_tokens=False).ids)
    text = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    for r in tokens.op2_token_counts(spark, sf).collect():
        t = text[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n(t), n(t) > 2048)
    c, rng = tokens.counter(path), random.Random(4)
    letters = [*"abcE''.!01", *"éß中한́Ị̧̇̇", "가", "ᄀ", "ᅡ", "ᆨ", "é", "re", "ll", "s", "<|endoftext|>", "Å", "̈́", "ก", "ำ", "া", "কে"]
    for _ in range(600):
        word = "".join(rng.choices(letters, k=rng.randint(1, 14)))
        assert list(c.table(word)) == [n(word[: k + 1]) for k in range(len(word))] and c.total(word.encode()) == n(word)
    clash = spark.createDataFrame([("x", "one two", 5, 6)], "doc_id string, text string, n_tokens long, fit_chars long")
    assert tokens.count_tokens(clash, path).columns == ["doc_id", "n_tokens", "fit_chars"]


def test_long_words_of_any_alphabet():
    """Tens of thousands of characters that normalising joins: read once, as the time shows."""
    import public_tokenizers

    c = tokens.counter(public_tokenizers.path("word_bpe_49k.json"))
    tokens._joining()
    syllables = unicodedata.normalize("NFD", "".join(chr(0xAC00 + k * 37 % 11172) for k in range(7000)))
    for word in (syllables, "กำ้" * 7000, "e" + "́" * 20_000, "ẹ́" * 7000):
        began = time.process_time()
        counts = c.table(word)
        assert len(counts) == len(word) and counts[-1] == c.total(word.encode())
        assert time.process_time() - began < 8


# --- op1 -----------------------------------------------------------------------------------------------------------


def test_warc_shards(spark):
    """Ten thousand bounds give each id its shard; hot ids are dealt by digest; files roll inside a shard; reruns agree."""
    bounds = [(3 * k, 0.0) for k in range(1, 10_000)] + [(40_000, 0.25), (40_000, 0.5)]
    named = lambda ids: ids.select("id", F.sha1(F.col("id").cast("string").cast("binary")).alias("d"))
    hot = named(spark.range(64)).withColumn("id", F.lit(40_000).cast("long"))
    for r in named(spark.range(0, 31_000, 7)).unionByName(hot).withColumn("s", warc.shard_column(bounds, F.col("id"), F.col("d"))).collect():
        part = int(r["d"][:12], 16) / 2**48
        assert r["s"] == sum((a, p) <= (r["id"], part) for a, p in bounds)
    rows = [(None if k % 3 == 0 else k, f"http://h/{k}", f"{k} " * 400) for k in range(120)]
    layout = warc.Layout(shard_bytes=20_000, file_bytes=300)
    schema = "page_id long, url string, html string"
    manifest = warc.write_archives(spark.createDataFrame(rows, schema), scratch_path(spark, "warc"), layout).collect()
    shards = {m["name"].split("-")[1] for m in manifest}
    assert len(shards) > 5 and len(manifest) > 2 * len(shards) and sum(m["records"] for m in manifest) == 120
    again = warc.write_archives(spark.createDataFrame(rows, schema), scratch_path(spark, "warc"), layout).collect()
    assert sorted((m["name"], m["sha1"]) for m in manifest) == sorted((m["name"], m["sha1"]) for m in again)
    folder = scratch_path(spark, "warc")
    none = spark.createDataFrame([], schema + ", _shard int")
    assert warc.read_archives(warc.write_archives(none, folder), folder).count() == 0


# --- op10 ----------------------------------------------------------------------------------------------------------


def test_repeats_beyond_the_packed_bits(spark):
    """Windows are told apart at every length."""
    rng = random.Random(6)
    for length in (3, 4, 50, 5000, 70_000):
        text = " ".join(rng.choice("abcdefgh") + str(rng.randrange(max(2, length // 6))) for _ in range(length))
        got = quality.features(spark.createDataFrame([(text,)], "text string")).select("_q.n_repeat_words").first()
        assert got[0] == _repeats(text)
    same = F.array(*[F.lit(x).cast("long") for x in (1, 2, 3, 9, 1, 2, 4, 8, 1, 2, 3)])
    assert spark.range(1).select(quality.repeated_window_words(same)).first()[0] == 6


def test_quality_counts_and_labels(spark, sf):
    """Base columns by plain loops, EM as a plain loop does it, and the verdicts against the labels."""
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    rows = quality.op10_quality_rules(spark, sf).collect()
    for r in rows:
        text = docs[r["doc_id"]]
        words, lines = _words(text), [x for x in text.split("\n") if _words(x)]
        expected = (len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), _repeats(text))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(words) < 50 or 100 * expected[4] > 50 * len(words)) and not (r["kept"] and r["base_failed"])
    counts = {}
    for r in rows:
        counts[r["votes"]] = counts.get(r["votes"], 0) + 1
    model, (prior, tables) = quality.fit(counts), _plain_em(counts)
    assert model.prior == pytest.approx(prior, abs=1e-4)
    assert all(model.good[k][v] == pytest.approx(tables[0][k][v], abs=1e-4) for k in range(len(quality.RULES)) for v in "012")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    told = [(labels[r["doc_id"]] == 1) == (r["posterior"] >= 0.5) for r in rows if r["doc_id"] in labels]
    assert sum(told) >= 0.95 * len(told) > 10
    bad = {"2222222000": 900, "0000000111": 100}
    assert quality.fit(bad).prior == 0.5 and quality.fit(bad, least=0.01).prior < 0.2


def _plain_em(counts):
    m, total = len(next(iter(counts))), sum(counts.values())
    prior, tables = 0.8, [[{"1": 0.5, "2": 0.2, "0": 0.3} for _ in range(m)], [{"2": 0.5, "1": 0.2, "0": 0.3} for _ in range(m)]]
    for _ in range(100):
        share = {}
        for p in counts:
            g = b = 1.0
            for k, v in enumerate(p):
                g, b = g * tables[0][k][v], b * tables[1][k][v]
            share[p] = prior * g / (prior * g + (1 - prior) * b)
        made = []
        for side, right in ((0, "1"), (1, "2")):
            made.append([])
            for k in range(m):
                seen = {v: 2.0 if v == right else 1.0 for v in "012"}
                for p, n in counts.items():
                    seen[p[k]] += n * (share[p] if side == 0 else 1 - share[p])
                made[-1].append({v: c / sum(seen.values()) for v, c in seen.items()})
        prior, tables = min(0.999, max(0.5, (sum(n * share[p] for p, n in counts.items()) + 4) / (total + 5))), made
    return prior, tables


# --- op6, op7 ------------------------------------------------------------------------------------------------------


def test_longest_match(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f g h i y c d"), (2, "z"), (3, "j k")], "doc_id long, text string")
    assert {r["doc_id"]: (r["_longest"], len(r["_spans"])) for r in decontaminate.find_hits(docs, items).collect()} == {1: (9, 0), 2: (0, 0), 3: (2, 0)}


def test_decontamination_query_brute(spark, sf):
    """The query over all documents against a plain search of every window."""
    docs = {r["doc_id"]: decontaminate.words((r["text"] or "").encode()) for r in table(spark, sf, "documents").collect()}
    windows = {}
    for r in table(spark, sf, "benchmark").collect():
        w = decontaminate.words((r["text"] or "").encode())
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    for r in decontaminate.op6_decontaminate(spark, sf).collect():
        w, hit, items = docs[r["doc_id"]], set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    items |= own
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(items), bool(hit))


def test_fingerprint_query_brute(spark, sf):
    """Fingerprints by another route to XXH64, and groups at the query's own radius."""
    import xxhash

    text = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    rows = {r["doc_id"]: r for r in simhash.op7_simhash(spark, sf).collect()}
    prints = {}
    for k, t in text.items():
        words = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [int.from_bytes(xxhash.xxh64(s.encode(), seed=42).digest(), "big") for s in shingles]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert rows[k]["fingerprint"] == f"{prints[k]:016x}"
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert all(rows[k]["component_id"] == find(k) for k in ids)


def test_keys_name_texts(spark, monkeypatch):
    """Texts that share a hash get keys of their own; a number that is taken is passed over."""
    docs = spark.createDataFrame([(k, f"text {k % 50}") for k in range(100)] + [(100, None), (101, "")], "doc_id long, text string")
    keys = simhash.text_keys(docs)
    assert keys == simhash.TextKeys()
    real = simhash.text_hash
    monkeypatch.setattr(simhash, "text_hash", lambda text, seed=0: F.pmod(real(text, seed), F.lit(7)))
    keys = simhash.text_keys(docs)
    rows = docs.select(keys.of("text").alias("k"), F.coalesce("text", F.lit("")).alias("t")).distinct().collect()
    assert len(rows) == len({r["k"] for r in rows}) == 51 and len(keys.moved) == 51 - len(keys.shared)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.count() == 51 and kept.columns == docs.columns


def test_names_of_own_columns(spark, sf):
    """Stages keep columns that are named like their own."""
    docs = table(spark, sf, "documents")
    odd = docs.select("*", F.lit("x").alias("_key"), F.lit(1).alias("_spans"), F.lit(2).alias("_words"), F.lit(3).alias("_id"), F.lit("r").alias("_root"))
    items = table(spark, sf, "benchmark")
    for step in (simhash.drop_near_duplicates, lambda d: decontaminate.decontaminate(d, items)):
        a, b = step(odd), step(docs)
        assert a.columns == odd.columns
        assert sorted(a.select(*docs.columns).collect()) == sorted(b.collect())
        assert a.filter("_key <> 'x' or _spans <> 1 or _words <> 2 or _id <> 3 or _root <> 'r'").count() == 0


def test_settled_removes_what_it_was_made_of(spark):
    """Only the result's table stays, also where a step fails or is built of steps like itself."""
    made = []

    def build():
        made.append(common.staged(spark.range(3).toDF("k"), "part"))
        made.append(common.settled(lambda: made[0].selectExpr("k + 1 as k"), "inner"))
        return made[1].selectExpr("k + 1 as k")

    def fails():
        made.append(common.staged(spark.range(3).toDF("k"), "part"))
        raise KeyError("no")

    out = common.settled(build, "whole")
    with pytest.raises(KeyError):
        common.settled(fails, "whole")
    assert sorted(r["k"] for r in out.collect()) == [2, 3, 4]
    assert len(made) == 3 and not any(os.path.exists(t._staged_at.removeprefix("file://")) for t in made)
    common.unstaged(out)
