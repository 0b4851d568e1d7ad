"""Fill-in-middle: a text is cut in three at borders of units, and its middle moved to the end.

Units are runs of ASCII letters and single other characters. A text's UTF-8 bytes become big integers with a bit
per byte: ``bytes.translate`` marks letters and the bytes that continue a character, shifts and boolean operations
mark where units begin, ``bit_count`` counts them, and the n-th is found by halving the integer again and again.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches, table, utf8

PLAIN, PSM, SPM = "plain", "psm", "spm"
MADE = ("fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_text")

_LETTERS = frozenset(string.ascii_letters.encode())
_IS_LETTER = bytes(48 + (b in _LETTERS) for b in range(256))
_IS_LATER = bytes(48 + (b >> 6 == 2) for b in range(256))


@dataclass(frozen=True)
class Markers:
    """What stands before each part. None may be the beginning or the end of another or hold one, which all of one length guarantees."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        three = (self.prefix, self.suffix, self.middle)
        if len(set(three)) < 3 or not all(three) or any(_runs_on(a, b) for a in three for b in three):
            raise ValueError("markers have to differ, hold something, and not overlap one another")


def _runs_on(a: str, b: str) -> bool:
    """Whether ``b`` can begin inside ``a``, so that the two overlap."""
    return any(b.startswith(a[k:]) or a[k:].startswith(b) for k in range(1 if a == b else 0, len(a)))


@dataclass(frozen=True)
class Rates:
    """Per hundred texts: how many are transformed, and how many of these put the suffix first."""

    moved: int = 90
    suffix_first: int = 20


def _mask(data: bytes, classes: bytes) -> int:
    """Bit i says whether byte i is of the class."""
    return int(data.translate(classes)[::-1], 2) if data else 0


def unit_starts(data: bytes) -> int:
    """Bit i says whether a unit begins at byte i."""
    letters, later = _mask(data, _IS_LETTER), _mask(data, _IS_LATER)
    inside = later | letters & letters << 1
    return ((1 << len(data)) - 1) & ~inside


def ranked_bit(bits: int, width: int, rank: int) -> int:
    """Position of the set bit with ``rank`` set bits below it; ``width`` where there are no more than ``rank``."""
    if bits.bit_count() <= rank:
        return width
    base, size = 0, 1 << max(0, width - 1).bit_length()
    while size > 1:
        size >>= 1
        lower = bits & ((1 << size) - 1)
        if (n := lower.bit_count()) > rank:
            bits = lower
        else:
            rank, bits, base = rank - n, bits >> size, base + size
    return base


def transform(data: bytes, h: tuple[int, int, int, int], markers: Markers, rates: Rates) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, characters of prefix and middle, and output of one text, by its four random numbers."""
    starts = unit_starts(data)
    n = starts.bit_count()
    p, s, m = (x.encode() for x in (markers.prefix, markers.suffix, markers.middle))
    if not data or p in data or s in data or m in data or h[2] % 100 >= rates.moved:
        return n, PLAIN, None, None, data
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = ranked_bit(starts, len(data), first), ranked_bit(starts, len(data), second)
    whole = ((1 << len(data)) - 1) & ~_mask(data, _IS_LATER)  # a bit per character
    prefix_chars = (whole & ((1 << a) - 1)).bit_count()
    middle_chars = (whole & ((1 << b) - 1)).bit_count() - prefix_chars
    form = SPM if h[3] % 100 < rates.suffix_first else PSM
    before, middle, after = data[:a], data[a:b], data[b:]
    moved = [s, after, p, before] if form == SPM else [p, before, s, after]
    return n, form, prefix_chars, middle_chars, b"".join((*moved, m, middle))


def random_numbers(id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits for an id, each a group of eight digits of one hash; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, text: str = "text", id: str = "doc_id", seed: int = 1, markers: Markers = Markers(), rates: Rates = Rates()) -> DataFrame:
    """``docs`` less its text, with ``fim_n``, ``fim_form``, ``fim_prefix_chars``, ``fim_middle_chars`` and ``fim_text``.

    The prefix ends after as many units as the smaller of two random numbers says, the middle after as many as the
    larger. A text that is empty, holds a marker, or isn't among the share to be moved keeps its form: ``plain``, with
    null lengths. A null text counts as empty, a null id as the empty id; rows with equal id and text get equal results,
    at every partitioning. Nothing is shuffled, a text takes time and memory in proportion to its length, and an empty
    table gives an empty result. Columns of ``docs`` with one of the new names are replaced; all others go through unchanged.
    """
    small_batches(docs.sparkSession, 128)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in MADE]
    given = F.struct(*[h.alias(f"h{k}") for k, h in enumerate(random_numbers(F.col(f"`{id}`"), seed))], utf8(f"`{text}`").alias("text"))
    source = docs.select(*kept, given.alias("fim_text"))
    kinds = ("long", "string", "long", "long")
    schema = docs.select(*kept, *[F.lit(None).cast(t).alias(c) for c, t in zip(MADE, kinds)], F.lit(b"").alias(MADE[-1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *h, texts = (c.to_pylist() for c in batch.columns[-1].flatten())
            rows = [transform(t, own, markers, rates) for t, *own in zip(texts, *h, strict=True)]
            made = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(v, t) for v, t in zip(made, types)]], names=[*batch.schema.names[:-1], *MADE])

    return source.mapInArrow(run, schema).withColumn("fim_text", F.col("fim_text").cast("string"))


def restored_text(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that an output of this form was made of; a column expression."""

    def between(begin: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, begin, -1), end, 1)

    middle = F.substring_index(output, markers.middle, -1)
    psm = F.concat(between(markers.prefix, markers.suffix), middle, between(markers.suffix, markers.middle))
    spm = F.concat(between(markers.prefix, markers.middle), middle, between(markers.suffix, markers.prefix))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` transformed, and rebuilt from the output; see ``fill_in_middle``."""
    moved = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return moved.select(
        "doc_id",
        F.col("fim_n").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        digest(F.col("fim_text")).alias("output_sha256"),
        digest(restored_text(F.col("fim_text"), F.col("fim_form"))).alias("restored_sha256"),
    )


ORACLE = """
with h as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as d from documents),
u as (
  select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as u,
    ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2, ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4 from h),
c as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
p as (
  select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:n], '') as s from c)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(p)::bigint end as prefix_chars, case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""
