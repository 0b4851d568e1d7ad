"""Line deduplication: repeated runs of lines, found by a suffix array over line ids.

Lines become ids; lines that occur once can't lie in a repeated run and end the sequences. Prefix
doubling ranks the suffixes: round k sorts the pairs (rank of the first half, rank of the half that
begins ``2 ** k`` lines later) and gives equal pairs one rank that follows the sort order. A pair that
occurs once gets none, so each round works on fewer rows. Suffixes that share at least L lines (an
interval of longest common prefixes of L or more) are those whose two ranks that cover L lines agree.

Those intervals are found by their names, the length and the two ranks, in one aggregation that combines before
the shuffle, and not by neighbours of the sorted array: the neighbours of a line that a third of all
documents hold would be one task. Ranks are needed up to the power of two below ``min_words``, as every line has a word.

L is set by words: from each line, the fewest lines that hold ``min_words`` words, and likewise back
from each line. The runs that share such a window with an earlier place make up exactly the repeated
runs of at least that many words; all of them but the first copy are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import id_key, settled, staged, table

NONSPACE = r"[^\x20\x09-\x0D]"
DOC = ["_d", "_t"]


def _keys(text: str) -> list[Column]:
    """A document is known by its id and its text's 128-bit hash; rows equal in both are one document."""
    return [id_key("doc_id").alias("_d"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("_t")]


def numbered_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row per line that has a word: document, place among such lines, line number, digest, words."""
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x, i: F.struct(i.alias("no"), x.alias("line")))
    rows = docs.select(*_keys(text), F.posexplode(F.filter(lines, lambda x: x["line"].rlike(NONSPACE))).alias("i", "x"))
    return rows.select(
        *DOC, "i", F.col("x.no").alias("no"),
        F.unhex(F.md5(F.col("x.line").cast("binary"))).alias("h"),
        F.regexp_count("x.line", F.lit(NONSPACE + "+")).alias("n"),
    )


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys found twice or more, each with a rank in their sort order. Written, so that ranks stay."""
    often = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return staged(often.orderBy(*keys).withColumn(name, F.monotonically_increasing_id()), "line-ranks")


def suffix_ranks(lines: DataFrame, levels: int) -> DataFrame:
    """Lines that recur, with ranks ``r0 .. r<levels>`` of the run of ``2 ** k`` lines that begins there.

    ``g`` numbers the stretches of consecutive recurring lines of a document. A null rank: the run
    crosses the end of its stretch, or it occurs once.
    """
    at = lines.join(_ranked(lines, ["h"], "r0"), "h").drop("h")
    at = at.repartition(*[F.col(c) for c in DOC]).dropDuplicates([*DOC, "i"])
    by_doc = Window.partitionBy(*DOC).orderBy("i")
    at = at.withColumn("g", F.col("i") - F.row_number().over(by_doc))
    stretch = Window.partitionBy(*DOC, "g").orderBy("i")
    at = staged(at.withColumn("c", F.sum("n").over(stretch)), "line-suffixes")
    for k in range(1, levels + 1):
        half = 2 ** (k - 1)
        at = at.withColumn("_b", F.lead(f"r{k - 1}", half).over(stretch))
        pairs = at.filter(F.col(f"r{k - 1}").isNotNull() & F.col("_b").isNotNull())
        ranks = _ranked(pairs.select(F.col(f"r{k - 1}").alias("_a"), "_b"), ["_a", "_b"], f"r{k}")
        if ranks.isEmpty():
            at = at.drop("_b").withColumns({f"r{j}": F.lit(None).cast("long") for j in range(k, levels + 1)})
            break
        found = pairs.join(ranks, (F.col(f"r{k - 1}") == ranks["_a"]) & (pairs["_b"] == ranks["_b"])).select(*DOC, "i", f"r{k}")
        at = staged(at.drop("_b").join(found, [*DOC, "i"], "left"), "line-suffixes")
    return at


def repeated_windows(ranked: DataFrame, levels: int, min_words: int) -> DataFrame:
    """Later copies of windows of at least ``min_words`` words: document, first and last line number.

    A stretch is an array; its windows forward and back are named by length and two ranks, and
    each name's first place, by document id and line, is the copy that stays. A later place in
    the same document counts where it doesn't overlap the first.
    """
    names = [f"r{k}" for k in range(levels + 1)]
    runs = ranked.groupBy(*DOC, "g").agg(F.array_sort(F.collect_list(F.struct("i", "no", "n", "c", *names))).alias("a"))
    runs = runs.filter(F.element_at("a", -1)["c"] >= min_words)

    def words(a: Column, first: Column, last: Column) -> Column:
        return F.get(a, last)["c"] - F.get(a, first)["c"] + F.get(a, first)["n"]

    def rank(a: Column, k: Column, at: Column) -> Column:
        where = F.get(a, at)
        chain = F.when(k == 0, where["r0"])
        for j in range(1, levels + 1):
            chain = chain.when(k == j, where[f"r{j}"])
        return chain

    def window(a: Column, first: Column, length: Column) -> Column:
        k = F.floor(F.log2(length.cast("double") + 0.5)).cast("int")
        rest = first + length - F.pow(F.lit(2), k).cast("int")
        return F.struct(
            F.get(a, first)["i"].alias("i"), F.get(a, first)["no"].alias("low"), F.get(a, first + length - 1)["no"].alias("high"),
            length.alias("m"), rank(a, k, first).alias("x"), rank(a, k, rest).alias("y"),
        )

    a = F.col("a")
    steps = F.sequence(F.lit(1), F.least(F.lit(min_words), F.size(a)))
    forward = F.transform(a, lambda _, p: F.struct(p.alias("p"), F.get(F.filter(steps, lambda m: (p + m <= F.size(a)) & (words(a, p, p + m - 1) >= min_words)), F.lit(0)).alias("m")))
    back = F.transform(a, lambda _, p: F.struct(p.alias("p"), F.get(F.filter(steps, lambda m: (p - m >= -1) & (words(a, p - m + 1, p) >= min_words)), F.lit(0)).alias("m")))
    ends = F.concat(
        F.transform(F.filter(forward, lambda w: w["m"].isNotNull()), lambda w: window(a, w["p"], w["m"])),
        F.transform(F.filter(back, lambda w: w["m"].isNotNull()), lambda w: window(a, w["p"] - w["m"] + 1, w["m"])),
    )
    found = runs.select(*DOC, F.explode(F.array_distinct(ends)).alias("w")).select(*DOC, "w.*").filter("x is not null and y is not null")
    found = staged(found, "line-windows")
    first = found.groupBy("m", "x", "y").agg(F.min(F.struct(*DOC, "i")).alias("f"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    later = found.join(first, ["m", "x", "y"]).filter((F.col("_d") != F.col("f._d")) | (F.col("_t") != F.col("f._t")) | (F.col("i") >= F.col("f.i") + F.col("m")))
    return later.select(*DOC, "low", "high")


def removed_ranges(docs: DataFrame, text: str = "text", min_words: int = 50) -> DataFrame:
    """Per document with later copies, the disjoint ranges of line numbers to delete."""
    levels = max(0, min_words.bit_length() - 1)
    ranked = suffix_ranks(staged(numbered_lines(docs, text), "lines"), levels)
    cuts = repeated_windows(ranked, levels, min_words).dropDuplicates()
    order = Window.partitionBy(*DOC).orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.withColumn("_new", F.when(before.isNull() | (F.col("low") > before + 1), 1).otherwise(0))
    cuts = cuts.withColumn("_k", F.sum("_new").over(order))
    merged = cuts.groupBy(*DOC, "_k").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return merged.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("_cut"))


def drop_repeated_runs(docs: DataFrame, text: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with ``text`` less its later copies, and ``_lines`` and ``_removed`` counts of lines.

    Lines are split at ``\\n`` and compared as they are; lines without a word take no part, but go
    where they lie inside a deleted run. The first copy is that of the smallest document id, nulls
    first, then of the smallest text hash, then the first in the text. No row is dropped: a
    document that is wholly a later copy keeps an empty text. A null text stays null. Rows that repeat
    an id and its text are one document and get the same result. Columns of ``docs`` are kept;
    one of the names ``_d _t _cut _lines _removed`` is replaced.
    """
    cuts = settled(lambda: removed_ranges(docs, text, min_words), "line-cuts")
    keyed = docs.withColumns(dict(zip(DOC, _keys(text), strict=True)))
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x, i: ~F.exists("_cut", lambda c: i.between(c["low"], c["high"])))
    # one plan at every size: cuts grow with the documents, so they are never sent to all tasks
    out = keyed.join(cuts.hint("merge"), DOC, "left")
    out = out.withColumn("_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    out = out.withColumn("_lines", F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.col("_lines")).cast("long"))
    gone = F.aggregate("_cut", F.lit(0), lambda s, c: s + c["high"] - c["low"] + 1)
    out = out.withColumn("_removed", F.coalesce(gone, F.lit(0)).cast("long"))
    return out.withColumn(text, F.when(F.col("_cut").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop(*DOC, "_cut")


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its text less the later copies of repeated line runs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_runs(docs).select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


ORACLE = r"""
with l as (
  select doc_id, no, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
  from (select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as no
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))
), w as (
  select doc_id, no, line, n, row_number() over (partition by doc_id order by no) as i,
         sum(n) over (partition by doc_id order by no) as c
  from l where n > 0
), rep as (select line from w group by line having count(*) > 1
), r as (
  select w.*, i - row_number() over (partition by doc_id order by i) as g from w semi join rep using (line)
), arr as (
  select doc_id, g, list(line order by i) as lines, list(c order by i) as cs, list(n order by i) as ns,
         list(no order by i) as nos, list(i order by i) as ids, count(*) as size
  from r group by doc_id, g having sum(n) >= 50
), p as (select *, unnest(range(1, size + 1)) as p from arr
), f as (
  select doc_id, ids, nos, lines, p as a,
         list_filter(range(p, size + 1), lambda e: cs[e] - cs[p] + ns[p] >= 50)[1] as b from p
  union all
  select doc_id, ids, nos, lines, list_filter(list_reverse(range(1, p + 1)), lambda s: cs[p] - cs[s] + ns[s] >= 50)[1] as a, p as b from p
), win as (
  select distinct doc_id, ids[a] as i, nos[a] as low, nos[b] as high, b - a + 1 as m, array_to_string(lines[a:b], chr(10)) as body
  from f where a is not null and b is not null
), fst as (select body, m, min((doc_id, i)) as first, count(*) as c from win group by body, m
), cut as (
  select distinct win.doc_id, no from win join fst using (body, m)
  join l on l.doc_id = win.doc_id and l.no between low and high
  where c > 1 and (win.doc_id <> first[1] or i >= first[2] + m)
)
select d.doc_id,
       case when d.text is null then null when k.doc_id is null then d.text else coalesce(kept, '') end as text,
       case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
       coalesce(gone, 0) as n_removed
from documents d
left join (select doc_id, count(*) as gone from cut group by doc_id) k using (doc_id)
left join (select l.doc_id, string_agg(line, chr(10) order by no) as kept from l anti join cut using (doc_id, no) group by l.doc_id) x using (doc_id)
"""
