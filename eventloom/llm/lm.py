"""Language-model scores by prediction by partial matching over bytes, beside a smoothed unigram base.

One pass over the training documents counts words and, for each context of four bytes, the bytes that
follow; Spark adds the counts up. Shorter contexts' counts follow by summing. The context trie
escapes by method C: where a context has seen q different symbols T times, a new symbol's share is q of
T + q, and symbols that a longer context has seen are excluded from the shorter ones. As the trie is
pretrained, all of that is resolved once into a row of log-probabilities per context, and scoring a text is
one look-up per byte. A 257th symbol ends a text, so a text's probability is a true one.

The model is the whole trie at every size. Contexts are dealt by head, their last three bytes. The commonest
heads, of bounded size, go to every task with all their contexts; places with other heads are counted per
text, priced once per different context and symbol from the table of counts, and joined back. Words' counts
are joined likewise: the commonest words go to every task, all others through a join by word,
which no common word can make uneven any more.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches, staged, table, utf8

ORDER = 4
END = 256
SYMBOLS = 257
#: The longest contexts whose counts go to tasks whole: 2 ** 16 contexts with 257 symbols at most.
SHORT = ORDER - 2
HEAD = (1 << 8 * (ORDER - 1)) - 1
#: What every task holds at most: counts of words, and of the commonest heads probabilities (4 bytes each) and counts of followers.
COMMON_WORDS = 150_000
CELLS = 24_000_000
FOLLOWERS = 2_000_000
#: Distinct words, and contexts with symbols, that a task counts before it passes them on.
HELD_WORDS = 250_000
HELD_GRAMS = 2_000_000


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over all texts of a batch: context and symbol at each place, which places count, and where each text starts.

    A text begins after ORDER zero bytes and ends with the symbol END.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    pad = bytes(ORDER)
    joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t)) + pad[1:], np.uint8)
    size = len(joined) - ORDER + 1
    context = np.zeros(size, np.uint32)
    for k in range(ORDER):
        context <<= 8
        context |= joined[k : k + size]
    symbol = np.zeros(size, np.uint16)
    symbol[:-1] = joined[ORDER:]
    starts = np.concatenate(([0], np.cumsum(sizes + ORDER)[:-1])) if len(texts) else np.zeros(0, np.int64)
    ends = starts + sizes
    symbol[ends] = END
    counts = np.ones(size, bool)
    for k in range(1, ORDER):
        past = ends + k
        counts[past[past < size]] = False
    return context, symbol, counts, starts


class _Grams:
    """Counts of context and symbol, merged from batch to batch."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: list[bytes]) -> None:
        if not texts:
            return
        context, symbol, counts, _ = windows(texts)
        self.parts.append(np.unique(context[counts].astype(np.int64) * 512 + symbol[counts], return_counts=True))
        if len(self.parts) > 40:
            self.parts = [self.total()]

    def size(self) -> int:
        """Distinct keys of the batches merged so far."""
        return len(self.parts[0][0]) if self.parts else 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, place = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``w, g, n``: how often each word (``g`` null) and each context with symbol (``w`` null) occurs in ``docs(_text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = _Grams(), Counter()
        for batch in batches:
            texts = [t.lower() for t in batch.column(0).to_pylist()]
            grams.add(texts)
            for t in texts:
                held.update(t.split())
            if len(held) > HELD_WORDS:
                yield _counted(held)
                held = Counter()
            if grams.size() > HELD_GRAMS:
                yield _summed(grams)
                grams = _Grams()
        yield _counted(held)
        yield _summed(grams)

    return docs.select("_text").mapInArrow(run, "w binary, g long, n long").groupBy("w", "g").agg(F.sum("n").alias("n"))


def _summed(grams: _Grams) -> pa.RecordBatch:
    keys, n = grams.total()
    return pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.binary()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["w", "g", "n"])


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.nulls(len(held), pa.int64()), pa.array(held.values(), pa.int64())], names=["w", "g", "n"])


def threshold(counts: DataFrame, limit: int, weight: Column | None = None) -> int:
    """The least ``n`` for which the rows of that ``n`` or more weigh ``limit`` at most in sum: two aggregations, no sort."""
    weight = F.lit(1) if weight is None else weight
    by_power = {int(r["p"]): r["c"] for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.sum(weight).alias("c")).collect()}
    total = 0
    for p in sorted(by_power, reverse=True):
        if total + by_power[p] > limit:
            inside = counts.filter(F.col("n").between(2**p, 2 ** (p + 1) - 1))
            step = max(1, 2**p // 256)
            parts = {int(r["q"]): r["c"] for r in inside.groupBy(F.floor(F.col("n") / step).alias("q")).agg(F.sum(weight).alias("c")).collect()}
            low = 2 ** (p + 1)
            for q in sorted(parts, reverse=True):
                if total + parts[q] > limit:
                    break
                total += parts[q]
                low = q * step
            return low
        total += by_power[p]
    return 1


class Counts:
    """Sorted counts of context and symbol by order, of which those of ORDER - 2 and less are of the whole corpus.

    ``keys, n`` hold all followers of some heads (the last ORDER - 1 bytes of a context), so what is
    resolved for a context with such a head is what the whole corpus says of it.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray]):
        self.sums = {ORDER: (keys, n), ORDER - 1: _shortened(keys, n, ORDER - 1), SHORT: short}
        for k in range(SHORT):
            self.sums[k] = _shortened(*short, k)

    def resolve(self, contexts: np.ndarray, k: int = ORDER) -> np.ndarray:
        """A row of all symbols' probabilities per context of ``k`` bytes; where it never occurred, its end counts."""
        p = np.zeros((len(contexts), SYMBOLS))
        seen = np.zeros(p.shape, bool)
        escape = np.ones((len(contexts), 1))
        for order in range(k, -1, -1):
            c = _dense(contexts & ((1 << 8 * order) - 1), *self.sums[order])
            fresh = np.where(seen, 0, c)
            total, kinds = fresh.sum(1, keepdims=True), (fresh > 0).sum(1, keepdims=True)
            whole = np.where(total > 0, total + kinds, 1)
            p += escape * fresh / whole
            escape = np.where(total > 0, escape * kinds / whole, escape)
            seen |= c > 0
        rest = SYMBOLS - seen.sum(1, keepdims=True)
        return p + np.where(seen, 0, escape / np.maximum(rest, 1))

    def rows(self, k: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The contexts of ``k`` bytes and the log10 probabilities of ``columns`` after each."""
        contexts = np.unique(self.sums[k][0] >> 9)
        out = [np.log10(self.resolve(contexts[at : at + 2048], k)[:, columns]).astype(np.float32) for at in range(0, len(contexts), 2048)]
        return contexts, np.concatenate(out) if out else np.zeros((0, len(columns)), np.float32)

    def prices(self, asked: np.ndarray) -> np.ndarray:
        """log10 probability of each context and symbol, sorted."""
        out, at = np.zeros(len(asked)), 0
        while at < len(asked):
            contexts = np.unique(asked[at : at + 2048] >> 9)
            past = int(np.searchsorted(asked, (contexts[-1] + 1) << 9))
            some = asked[at:past]
            out[at:past] = np.log10(self.resolve(contexts)[np.searchsorted(contexts, some >> 9), some & 511])
            at = past
        return out


def _shortened(keys: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    own, place = np.unique(((keys >> 9) & ((1 << 8 * k) - 1)) * 512 + (keys & 511), return_inverse=True)
    return own, np.bincount(place, n, len(own))


def _dense(contexts: np.ndarray, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    own, place = np.unique(contexts, return_inverse=True)
    low, high = np.searchsorted(keys, own * 512), np.searchsorted(keys, own * 512 + 512)
    sizes = high - low
    row = np.repeat(np.arange(len(own)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
    dense = np.zeros((len(own), SYMBOLS))
    dense[row, keys[at] & 511] = n[at]
    return dense[place]


class Scorer:
    """In a task: from a context's bytes to its row, or to that of its head, where the head is a common one."""

    def __init__(self, alphabet: np.ndarray, heads: np.ndarray, contexts: np.ndarray, table: np.ndarray):
        self.table = table
        self.size = size = len(alphabet) + 1  # one more letter stands for all other bytes
        self.letter = np.full(256, size - 1, np.int32)
        self.letter[alphabet] = np.arange(len(alphabet))
        self.column = np.full(SYMBOLS, len(alphabet) + 1, np.int32)
        self.column[alphabet] = np.arange(len(alphabet))
        self.column[END] = len(alphabet)
        self.head = np.full(size**3, -1, np.int32)
        self.head[self._place(heads)] = np.arange(len(heads), dtype=np.int32)
        self.longer = np.full(len(heads) * size, -1, np.int32)
        self.longer[self.head[self._place(contexts)] * size + self.letter[contexts >> 24]] = len(heads) + np.arange(len(contexts), dtype=np.int32)

    def _place(self, contexts: np.ndarray) -> np.ndarray:
        return (self.letter[(contexts >> 16) & 255] * self.size + self.letter[(contexts >> 8) & 255]) * self.size + self.letter[contexts & 255]

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Per text the sum over places with a common head; the other places' contexts with symbols, and how often each."""
        if not texts:
            return np.zeros(0), pa.array([], pa.list_(pa.int64())), pa.array([], pa.list_(pa.int64()))
        context, symbol, counts, starts = windows(texts)
        head = self.head[self._place(context)]
        common = np.flatnonzero(head >= 0)
        row = head[common]
        longer = self.longer[row * self.size + self.letter[context[common] >> 24]]
        each = np.zeros(len(context))
        each[common] = self.table[np.where(longer >= 0, longer, row), self.column[symbol[common]]]
        each[~counts] = 0
        other = np.flatnonzero(counts & (head < 0))
        text = np.searchsorted(starts, other, "right") - 1
        grams, times = np.unique((text << 41) | (context[other].astype(np.int64) << 9) | symbol[other], return_counts=True)
        offsets = pa.array(np.searchsorted(grams, np.arange(len(texts) + 1) << 41), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (grams & ((1 << 41) - 1), times)]
        return np.add.reduceat(each, starts), *lists


def priced(asked: DataFrame, grams: DataFrame, sent) -> DataFrame:
    """``g, p``: the log10 probability of each context and symbol of ``asked(g)``, which are distinct.

    Both tables are dealt out by head. A head has 256 contexts of 257 symbols at most, so no group is
    large; tasks go from head to head in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > HELD_GRAMS:
                g, n = (np.concatenate(x) for x in zip(*held, strict=True))
                heads = (g >> 9) & HEAD
                cut = int(np.flatnonzero(heads != heads[-1]).max(initial=-1)) + 1
                yield _priced(g[:cut], n[:cut], sent.value)
                held, size = [(g[cut:], n[cut:])], len(g) - cut
        if held:
            yield _priced(*(np.concatenate(x) for x in zip(*held, strict=True)), sent.value)

    both = grams.select("g", "n").unionByName(asked.select("g", F.lit(0).cast("long").alias("n")))
    head = F.shiftright("g", 9).bitwiseAND(F.lit(HEAD).cast("long"))
    return both.repartition(head).sortWithinPartitions(head).mapInArrow(run, "g long, p double")


def _priced(g: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    asked = np.sort(g[n == 0])
    known = np.flatnonzero(n)
    known = known[np.argsort(g[known])]
    p = Counts(g[known], n[known], short).prices(asked)
    return pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array(p, pa.float64())], names=["g", "p"])


_scorers: dict[str, tuple[Scorer, dict[bytes, float]]] = {}


def _held(key: str, sent) -> tuple[Scorer, dict[bytes, float]]:
    if key not in _scorers:
        _scorers.clear()
        alphabet, heads, contexts, rows, common, n = sent.value
        _scorers[key] = Scorer(alphabet, heads, contexts, rows), dict(zip(common.to_pylist(), np.log10(n + 1.0).tolist(), strict=True))
    return _scorers[key]


def held_out():
    """The documents that nothing is learned from; a null id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, text: str = "text", common_words: int = COMMON_WORDS, followers: int = FOLLOWERS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document.

    Null and empty texts hold the end alone. Repeated rows are counted and scored each; without training
    documents every symbol is equally likely and no token known. An empty table gives an empty
    result. Other columns are not used. What ``common_words`` and ``followers`` bound is how much goes to every
    task; results don't depend on them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", held_out().alias("held_out"), utf8(text).alias("_text"))
    learned = rows.filter(~F.col("held_out"))
    counts = staged(corpus_counts(learned), "corpus-counts")
    words, grams = counts.filter("w is not null").select("w", "n"), counts.filter("g is not null").select("g", "n")
    seen = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = grams.filter(F.col("g") % 512 == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_train, v_train = seen["n"] + ends, seen["v"] + (1 if ends else 0)

    common = words.filter(F.col("n") >= threshold(words, common_words)).toArrow()
    short = grams.groupBy(F.col("g").bitwiseAND(F.lit((1 << 8 * SHORT + 9) - 1).cast("long")).alias("g")).agg(F.sum("n").alias("n")).toArrow().sort_by("g")
    short = short.column("g").to_numpy(), short.column("n").to_numpy()
    alphabet = np.setdiff1d(np.append(short[0] & 511, 0), [END])
    columns = np.array([*alphabet, END, next((x for x in range(256) if x not in set(alphabet.tolist())), 0)])
    grams = grams.withColumn("h", F.shiftright("g", 9).bitwiseAND(F.lit(HEAD).cast("long")))
    heads = grams.groupBy("h", F.shiftright("g", 9).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("f"))
    heads = staged(heads.groupBy("h").agg(F.sum("n").alias("n"), F.sum("f").alias("f"), (F.count(F.lit(1)) + 1).alias("r")), "heads")
    low = max(threshold(heads, followers, F.col("f")), threshold(heads, CELLS // len(columns), F.col("r")))
    model = grams.join(heads.filter(F.col("n") >= low).select("h"), "h", "left_semi").select("g", "n").toArrow().sort_by("g")
    model = Counts(model.column("g").to_numpy(), model.column("n").to_numpy(), short)
    (known_heads, head_rows), (contexts, context_rows) = model.rows(ORDER - 1, columns), model.rows(ORDER, columns)
    sent = spark.sparkContext.broadcast((alphabet, known_heads, contexts, np.concatenate([head_rows, context_rows]), common.column("w").combine_chunks(), common.column("n").to_numpy()))
    short_sent = spark.sparkContext.broadcast(short)
    key, end_log = uuid.uuid4().hex, math.log10(ends + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, logs = _held(key, sent)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t.lower() for t in batch.column(2).to_pylist()]
            sums, known, sizes, rare, times = [], [], [], [], []
            for t in texts:
                tokens = t.split()
                found = [x for x in map(logs.get, tokens) if x is not None]
                rest: Counter = Counter()
                if len(found) < len(tokens):
                    rest.update(w for w in tokens if w not in logs)
                sums.append(math.fsum(found) + end_log)
                known.append(len(found) + (ends > 0))
                sizes.append(len(tokens) + 1)
                rare.append(list(rest.keys()))
                times.append(list(rest.values()))
            score, places, often = scorer.score(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(uid, uid + len(texts)), pa.int64()), batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(sums, pa.float64()), pa.array(score, pa.float64()), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())),
                    places, often,
                ],
                names=["uid", "doc_id", "held_out", "n_tokens", "known", "logs", "common_score", "rare", "times", "places", "often"],
            )
            uid += len(texts)

    kind = dict(docs.dtypes)["doc_id"]
    scored = staged(rows.mapInArrow(run, f"uid long, doc_id {kind}, held_out boolean, n_tokens long, known long, logs double, common_score double, rare array<binary>, times array<long>, places array<long>, often array<long>"), "scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("uid", F.col("x.rare").alias("w"), F.col("x.times").alias("k"))
    rare = rare.join(words, "w").groupBy("uid").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"))
    places = scored.select("uid", F.explode(F.arrays_zip("places", "often")).alias("x")).select("uid", F.col("x.places").alias("g"), F.col("x.often").alias("k"))
    asked = places.select("g").dropDuplicates()
    rest = grams.join(heads.filter(F.col("n") < low).select("h"), "h", "left_semi")
    prices = staged(priced(asked, rest, short_sent), "prices")
    places = places.join(prices, "g").groupBy("uid").agg(F.sum(F.col("k") * F.col("p")).alias("other_score"))
    out = scored.drop("rare", "times", "places", "often").join(rare, "uid", "left").join(places, "uid", "left")
    base = F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * math.log10(n_train + v_train + 1)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("common_score") + F.coalesce("other_score", F.lit(0.0))).alias("score"))


def op9_lm_scores(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
