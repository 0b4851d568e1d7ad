"""Brute force and edge cases of the corpus operators, on small frames."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import chat, decontaminate, graph, html_text, lines, lm, mixing, quality, simhash, tokens, warc
from eventloom.llm.common import scratch_path, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _t string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, white space of several kinds, and a column with a clashing name."""
    prose = " ".join(f"word{k % 97}" for k in range(300)) + "."
    rows = [
        (1, None, "en", "a", None, "x"),
        (2, "", None, None, 0, None),
        (None, "a\tb\r\nc \x0b d", "en", "b", 9, "y"),
        (3, prose, "en", "a", 1, "z"),
        (3, prose, "en", "a", 1, "z"),
        (4, "x " * 20_000, "en", "a", 40_000, "z"),
        (5, prose + "\n" + prose, "en", None, 2, "z"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _repeats(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    where = {}
    for k in range(len(words) - 2):
        where.setdefault(tuple(words[k : k + 3]), []).append(k)
    return len({k + j for v in where.values() if len(v) > 1 for k in v for j in range(3)})


def test_quality(spark, odd, none, sf):
    given = table(spark, sf, "documents").select("text").union(odd.select("text"))
    for r in quality.features(given).select("text", "_q.*").collect():
        assert r["n_repeat_words"] == _repeats(r["text"])
        assert r["word_chars"] == len(re.sub(r"[\x20\x09-\x0d]", "", r["text"] or ""))
    assert quality.keep_good(none).count() == 0
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} <= {3, 5}


def test_line_runs(spark, none, odd):
    passage = "\n".join(" ".join(f"p{k}{j}" for j in range(12)) for k in range(6))
    other = "\n".join(" ".join(f"q{k}{j}" for j in range(12)) for k in range(3))
    docs = spark.createDataFrame([(1, passage), (2, "head\n" + passage + "\n\ntail"), (3, other), (4, other + "\nown"), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["_removed"]) for r in lines.drop_repeated_runs(docs).collect()}
    assert got == {1: (passage, 0), 2: ("head\n\ntail", 6), 3: (other, 0), 4: (other + "\nown", 0), 5: (None, 0)}  # 36 words stay
    assert lines.drop_repeated_runs(none).count() == 0
    assert lines.drop_repeated_runs(odd).count() == odd.count()


def test_tokens(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs = Tokenizer.from_file(path)
    c = tokens.counter(path)
    random.seed(1)
    alphabet = [*"abcdefghijklmnopqrstuvwxyzE", *"'''.,!-0123", *"éßñ中한́İ", "<|endoftext|>", "'re", "tion", " ", "\n"]
    for _ in range(200):
        text = "".join(random.choices(alphabet, k=25))
        assert sum(map(c.total, text.encode().split())) == len(theirs.encode(text, add_special_tokens=False).ids)
        if text.isascii():
            assert list(c.prefixes(text.encode())) == [len(theirs.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    got = tokens.count_tokens(odd, path, limit=5, store=True)
    assert got.filter(F.col("n_tokens") <= 5).count() == 3
    assert got.filter("doc_id = 3").select((tokens.longest_prefix(F.col("prefix_tokens"), 5) == F.col("fit_chars")).alias("x")).first()["x"]
    assert tokens.count_tokens(none, path).count() == 0


def test_html(spark):
    nav = "<div class='box'><ul><li>Home page</li><li>All topics</li></ul></div>"
    rows = [(k, "http://h/%d" % k, f"<body>{nav}<p>Own &amp; text {k}</p></body>") for k in range(12)]
    rows += [(90, None, None), (91, "http://o/", "<nav>x</nav><article><h1>T&nbsp; t</h1><p>a<br>b<div class='comments'>no</div><script>1</script></article><footer>f</footer>"), (91, "http://o/", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1000, 0):
        got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.main_text(frame, broadcast_limit=limit).collect())
        assert got[0] == (0, "Own & text 0", 12) and got[-2:] == [(91, "", 0), (91, "T t\na\nb", 7)]
        assert (90, "", 0) in got


def test_html_templates(spark):
    """Boilerplate in any element and on hosts of few pages; sentences and copied articles stay."""
    tail = "<p>Under this licence.</p><ul><li>Read more</li></ul><span>Back to top</span>"
    own = [" ".join(f"own{k}{j}" for j in range(30)) for k in range(5)]
    rows = [(k, f"http://few/{k}", f"<article><p>{own[k]} is <em>not</em> it</p>{tail}</article>") for k in range(5)]
    rows += [(10 + k, f"http://copies/{k}", f"<div>Seen {k}</div><article><p>{own[0]}</p><p>{own[1]}</p></article>") for k in range(6)]
    rows += [(20 + k, f"http://edits/{k}", f"<article><p>{own[0]}</p><p>{own[1]}</p><p>edit {k}</p></article>") for k in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1000, 0):
        got = {r["page_id"]: r["text"] for r in html_text.main_text(frame, broadcast_limit=limit).collect()}
        assert all(got[k] == f"{own[k]} is not it" for k in range(5))
        assert all(got[10 + k] == f"{own[0]}\n{own[1]}" for k in range(6))
        assert all(got[20 + k] == f"{own[0]}\n{own[1]}\nedit {k}" for k in range(4))


def test_html_names():
    """Names that only contain a declared word, headings' ids, and several main containers."""
    read = lambda html: html_text.blocks(html_text.parse(html), lambda _: False)

    def marked(html):
        root = html_text.parse(html)
        html_text.hash_subtrees(root, "h")
        return html_text.blocks(root, lambda _: False)

    post = "<article class='post category-social tag-related'><h2 id='related-work'>Related work</h2><p class='notice'>a</p><section id='search-results'><p>b</p></section><div class='share'>no</div><div class='cookie-bar'>no</div></article>"
    for way in (read, marked):
        assert way(post) == ["Related work", "a", "b"]
        assert way("<body><div class='site-footer'>no</div><h2 id='search'>c</h2><p>d</p></body>") == ["c", "d"]
        assert way("<body><div class='main-menu'>no</div><div class='main-image'>e</div><div class='main-content'><p>f</p><div class='main'>g</div></div><p>no</p></body>") == ["e", "f", "g"]


def test_html_comments_and_adverts():
    """Reader comments, adverts and other posts go by either end of their name, articles among them too; names that say what is there stay."""

    def texts(html):
        root = html_text.parse(html)
        html_text.hash_subtrees(root, "h")
        return html_text.blocks(root, lambda _: False)

    gone = [
        "<section class='post-comments'>no</section>", "<div id='user-comments'>no</div>", "<div id='reader-comments'><p>no</p></div>", "<div class='fb-comments'>no</div>",
        "<div id='disqus_thread'>no</div>", "<div class='ad-slot'>no</div>", "<div class='advert-300x250'>no</div>", "<div class='sponsored-content'><p>no</p></div>",
        "<div class='social-icons'>no</div>", "<article class='comment'><p>no</p></article>", "<div id='comments'><article class='comment'>no</article></div>",
        "<div class='related'><article><p>no</p></article><article>no</article></div>", "<div class='comment-list'><article><p>no</p></article></div>",
    ]
    for x in gone:
        assert texts(f"<body><article><p>a</p>{x}<p>b</p></article></body>") == ["a", "b"], x
        assert texts(f"<body><div class='page'><article><p>a</p></article>{x}</div></body>") == ["a"], x
        assert texts(f"<body><div class='page'>{x}<main><p>a</p></main></div></body>") == ["a"], x
    for name in ("has-sidebar", "no-comments", "category-social", "tag-related", "comments-open", "with-ads", "adsorption", "social-history", "share-price", "related-work"):
        assert texts(f"<body><article class='post {name}'><p>a</p><div class='{name}'><p>b</p></div></article></body>") == ["a", "b"], name
    # what holds all articles of a page, or its main container, stays whatever its name
    assert texts("<body><div class='related-posts'><article><p>a</p></article><article><p>b</p></article></div></body>") == ["a", "b"]
    assert texts("<body><div class='layout-sidebar'><main><p>a</p></main></div><article><p>b</p></article></body>") == ["a", "b"]


def test_chat(spark):
    rows = [(1, 1, "assistant", "b\\<s>[INST]"), (1, 0, "user", None), (2, 0, "odd [:] role", "x"), (None, 0, None, "[/ROLE]")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\nb\\<s>[INST]\n") and got[1]["loss_sha256"] == sha("b\\<s>[INST]") and got[1]["valid"]
    assert got[2]["turns_sha256"] == sha("odd [:] role\nx\n") and not got[2]["valid"]
    assert got[None]["n_turns"] == 1 and got[None]["turns_sha256"] == sha("\n[/ROLE]\n")


def test_automaton():
    random.seed(3)
    for _ in range(500):
        w, letters = random.choice([2, 3, 4]), [b"a", b"b", b"c"][: random.randint(1, 3)]
        items = [(str(k), random.choices(letters, k=random.randint(0, 8))) for k in range(random.randint(0, 5))]
        doc = random.choices([*letters, b"z"], k=random.randint(0, 25))
        hit, owners = set(), set()
        for name, s in items:
            k = min(w, len(s))
            for a in range(len(doc) - k + 1):
                if k and any(doc[a : a + k] == s[b : b + k] for b in range(len(s) - k + 1)):
                    hit.update(range(a, a + k))
                    owners.add(name)
        spans, own, _ = decontaminate.SuffixAutomaton(items, w).match(doc)
        assert {k for a, b in spans for k in range(a, b)} == hit and own == owners


def test_decontaminate(spark, odd, none):
    items = spark.createDataFrame([(7, "One two three four five six seven eight nine ten."), (None, "a b"), (8, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Start here: one, TWO three four five six seven eight nine ten; the end of it all and more words follow")], "doc_id long, text string")
    assert decontaminate.decontaminate(docs, items).first()["text"] == "Start here: ; the end of it all and more words follow"
    assert decontaminate.find_hits(odd, items, block_words=3).count() == odd.count()
    assert decontaminate.find_hits(none, items).count() == 0
    assert decontaminate.find_hits(odd, items.limit(0)).filter("size(_spans) > 0").count() == 0


def test_simhash(spark, sf, odd, none):
    extra = spark.createDataFrame([(9001, None), (9002, ""), (None, "a b c")], "doc_id long, text string")
    docs = table(spark, sf, "documents").select("doc_id", "text").union(extra)
    got = simhash.group_by_simhash(docs, radius=6).collect()  # a ball of radius 3 in each of two segments
    prints = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in got}
    ids = sorted(prints, key=lambda i: -(2**63) if i is None else i)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 6:
                a, b = sorted((find(i), find(j)), key=ids.index)
                root[b] = a
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in ids}
    assert simhash.group_by_simhash(none).count() == 0
    assert simhash.drop_near_duplicates(odd).count() == 4


def _jaccard_groups(texts, width=5, similarity=0.8):
    """The number of components of all pairs that are similar enough, by comparing all."""
    sets = [set(simhash.shingle_hashes(t.encode(), width).tolist()) for t in dict.fromkeys(texts)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return sum(find(i) == i for i in range(len(sets)))


@pytest.mark.parametrize("block", [16, 512])
def test_similar_groups_brute(spark, block):
    """Stars (copies are like their original only), rings of small steps, and texts that are nearly but not similar."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"

    def edited(words, n):
        words = list(words)
        for k in rng.sample(range(len(words)), n):
            words[k] = word()
        return words

    made = []
    for copies, edits in ((150, 10), (40, 10), (30, 16)):
        original = [word() for _ in range(500)]
        made += [original, *(edited(original, edits) for _ in range(copies))]
    step = [word() for _ in range(300)]
    for _ in range(12):
        step = edited(step, 5)
        made.append(step)
    texts = [" ".join(w) for w in made] + ["", " ", "\t", "a b", "a  b", "one two three four five six"]
    rng.shuffle(texts)
    groups = _jaccard_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.similar_groups(docs, block=block)
    assert len(texts) - found.count() + found.select("_root").distinct().count() == groups
    if block == 512:
        assert simhash.drop_near_duplicates(docs).count() == groups


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 200), (300, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 200: 100, 300: 100}


def test_mixing(spark, sf, odd, none):
    got = mixing.mix(table(spark, sf, "documents")).toPandas()
    assert (got.taken <= 3 * got["size"]).all()
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by.taken - by.target) <= 0.1 * by.target + 128).all() and abs(by.target.sum() - by["size"].sum()) < 1
    assert mixing.mix(none).count() == 0 and mixing.mix(odd).count() == odd.count()


def test_mix_rows(spark, odd, none):
    """The mix itself: slots, blocks and pieces of text, and what is taken follows from it."""
    rng = random.Random(2)
    sizes = {"a": [300, 1, 64, 700, 0, 5], "b": [65], "c": [3], None: [130, 20], "d": [900, 40, 40]}
    rows = [(k, "  " + "".join(rng.choice(["é", "x1", "b,"]) + rng.choice([" ", "\n", "\t "]) for _ in range(n)), s) for k, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    text = {k: t for k, t, _ in rows}
    made = mixing.make_mix(docs).orderBy("slot", "place").toPandas()
    by = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert sorted(made.slot.unique()) == list(range(made.slot.nunique()))
    for r in made.itertuples():
        assert r.piece.split() == text[r.doc_id].split()[r.first_word : r.past_word]
    words = (made.past_word - made.first_word).groupby(made.doc_id).sum()
    assert all(words.get(k, 0) == by[k]["taken"] for k in by)
    for source, ns in sizes.items():
        own = made[made.source.isna() if source is None else made.source == source]
        n, target = -(-sum(ns) // 64), next(r["target"] for r in by.values() if r["source"] == source)
        drawn = (own.past_word - own.first_word).sum()
        assert target - 1e-3 <= drawn < target + 64
        order = own.drop_duplicates("slot")
        assert sorted(order.block) == sorted(k % n for k in range(len(order)))
        for _, slot in own.groupby("slot"):
            at = (slot.past_word - slot.first_word).cumsum()
            assert [0, *at[:-1]] == slot.place.tolist() and at.iloc[-1] == min(64, sum(ns) - 64 * slot.block.iloc[0])
    whole = made[made.slot.isin(made.drop_duplicates(["source", "block"]).slot)].sort_values(["doc_id", "first_word"])
    assert all("".join(g.piece) == text[k] for k, g in whole.groupby("doc_id") if g.past_word.max() == len(text[k].split()) and g.first_word.is_unique and (g.past_word - g.first_word).sum() == g.past_word.max())
    assert mixing.make_mix(none).count() == 0 and mixing.make_mix(odd).filter("piece is null").count() == 0


def _ppm(train, text, order=4):
    """Prediction by partial matching, symbol by symbol."""
    seen = {}
    for t in train:
        line = [0] * order + list(t.lower()) + [256]
        for i in range(order, len(line)):
            for k in range(order + 1):
                own = seen.setdefault(tuple(line[i - k : i]), {})
                own[line[i]] = own.get(line[i], 0) + 1
    line, total = [0] * order + list(text.lower()) + [256], 0.0
    for i in range(order, len(line)):
        p, out = 1.0, set()
        for k in range(order, -1, -1):
            fresh = {x: n for x, n in seen.get(tuple(line[i - k : i]), {}).items() if x not in out}
            whole = sum(fresh.values()) + len(fresh)
            if line[i] in fresh:
                p *= fresh[line[i]] / whole
                break
            if fresh:
                p *= len(fresh) / whole
                out |= set(fresh)
        else:
            p /= 257 - len(out)
        total += math.log10(p)
    return total


@pytest.mark.parametrize("followers", [0, 300, lm.FOLLOWERS])
def test_lm_brute(spark, odd, followers):
    rng = random.Random(7)
    rows = [(k, "".join(rng.choice("abcé X\n") for _ in range(rng.randrange(60)))) for k in range(40)] + [(50, None), (None, "zzü"), (51, "the same"), (51, "the same")]
    out = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), common_words=3, followers=followers).collect()
    taught = [(t or "").encode() for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    expected = sorted((str(k), round(_ppm(taught, (t or "").encode()), 3)) for k, t in rows)
    assert [(k, pytest.approx(v, abs=2e-3)) for k, v in expected] == sorted((str(r["doc_id"]), r["score"]) for r in out)
    assert any(r["held_out"] for r in out) and len(lm.score_documents(odd, followers=followers).collect()) == odd.count()


def test_lm(spark, sf, odd, none):
    assert lm.score_documents(none).count() == 0
    got = lm.score_documents(odd).collect()
    assert len(got) == odd.count() and all(r["score"] < 0 for r in got)
    few = lm.score_documents(table(spark, sf, "documents"), common_words=50, followers=5000).toPandas().sort_values("doc_id")
    all_ = lm.score_documents(table(spark, sf, "documents")).toPandas().sort_values("doc_id")
    assert (abs(few.score.values - all_.score.values) < 1e-2).all()
    assert (abs(few.base_score.values - all_.base_score.values) < 1e-6).all() and (few.n_known.values == all_.n_known.values).all()


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "http://h/ä b", big), (2, None, big), (5, "u", big), (3, "u", None), (4, "u", "short"), (6, "u", "short"), (2, None, big)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(frame, folder, warc.Layout(shard_bytes=1500, file_bytes=500))
    got = warc.read_archives(manifest, folder).collect()
    assert all(r["verified"] for r in got) and manifest.count() > 1
    kinds = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got), key=str)
    assert kinds == [(1, 1200, "revisit", 5), (2, 1200, "revisit", 5), (2, 1200, "revisit", 5), (3, 0, "response", None), (4, 5, "response", None), (5, 1200, "response", None), (6, 5, "response", None)]


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "decontaminate", "mixing"]
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() < docs.count() and out.filter("taken > 3 * size").count() == 0


def test_sketches_never_understate():
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 60, 400, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for kept in (0.0, 0.5, 0.9, 1.0):
            own = a[: int(len(a) * kept)]
            b = np.unique(np.concatenate([own, rng.integers(0, 2**63, int(size * (1.1 - kept))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            most = simhash._most_shared(len(a), simhash._sketch(a), len(b), simhash._sketch(b))
            assert both <= most <= min(len(a), len(b))
            if size >= 400 and kept == 0.5:
                assert most < 0.8 * size
