"""Document fingerprints from closed syncmers, in DataFrame operations.

A text is a sequence of symbols: its words between spaces, line ends and tabs,
of which longer ones are cut into pieces of ``PIECE`` characters; so texts of
any length and script have the same kind of symbols. With K - 1 marks before
and after, every run of K symbols is a k-mer, and each S symbols in it an inner
substring; a k-mer is an anchor (a closed syncmer) if the least hash of its
inner substrings is the first's or the last's. That depends on the k-mer
alone, not on its surroundings, so an edit changes only the anchors that touch
it; about two thirds of all places are anchors.

The fingerprint holds every anchor: the upper 32 bits of their hashes as
signed decimal numbers, in order, with a space between. Everything compared is
computed from these numbers. The likeness of two texts is the share of anchors
that they have in common, 2c / (a + b), repeats counted. The positional match
is the same share of links: an anchor, the next one, and the places between
them. So a shared passage matches wherever it stands, and moved pieces do not.

Higher-order functions do the work on arrays within a row; arrays are bound by
one-element ``transform`` calls so that each is computed once.

Defined cases: NULL counts as empty; a text without symbols, or of whose
k-mers none is an anchor, has one anchor, its whole; equal texts have equal
fingerprints; a very long text is worked on whole, as arrays of one row;
documents are ordered by id (NULL first), rows of one id by their text's hash,
and if an id alone has the rows of two ranges, by a hash of the number they
get as the documents are stored, which is done in that case only; a single
document is its own next one; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import stored

K, S, PIECE = 4, 2, 16
COMPARED = ("anchors", "links")
#: Rows of a range; from MAX_RANGES times as many documents on (4 million), ranges have more rows instead.
RANGE_ROWS, MAX_RANGES = 256, 16_384


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _anchors(text: str) -> str:
    """SQL for the anchors (place, hash) of a text, with places from 0 for the first mark."""
    inner = ", ".join(["x", *(f"get(h, i + {j})" for j in range(1, S))])
    edge = f"least(get(m, i), get(m, i + {K - S}))"
    middle = " and ".join(f"{edge} <= get(m, i + {j})" for j in range(1, K - S))
    # the inner substrings at both ends cover the k-mer, as 2S >= K
    found = f"""filter(transform(sequence(0, size(h) - {K}),
                   i -> if({middle}, named_struct('place', i, 'hash', xxhash64(get(m, i), get(m, i + {K - S}))), null)),
               a -> a is not null)"""
    symbols = f"regexp_extract_all({text}, '[^ \\\\n\\\\r\\\\t]{{1,{PIECE}}}', 0)"
    marked = f"concat(array_repeat(xxhash64(''), {K - 1}), transform(w, x -> xxhash64(x)), array_repeat(xxhash64(' '), {K - 1}))"
    every = f"if(size(w) = 0, cast(array() as array<struct<place:int,hash:bigint>>), {_let(marked, 'h', _let(f'transform(h, (x, i) -> xxhash64({inner}))', 'm', found))})"
    whole = f"array(named_struct('place', 0, 'hash', xxhash64({text})))"
    return _let(symbols, "w", _let(every, "f", f"if(size(f) > 0, f, {whole})"))


def anchors(text: str) -> Column:
    """place and hash of all anchors of the text column, in order."""
    return F.expr(_anchors(text))


def _counted(values: str) -> str:
    """SQL for an array in which a repeated value's further occurrences are values of their own, so that sets of them count repeats."""
    starts = "filter(sequence(0, size(v) - 1), i -> i = 0 or v[i] != v[i - 1])"
    runs = """flatten(transform(starts, (a, j) -> transform(sequence(0, coalesce(get(starts, j + 1), size(v)) - a - 1),
                  o -> if(o = 0, v[a], xxhash64(v[a], o)))))"""
    return f"if(size(array_distinct({values})) = size({values}), {values}, {_let(f'sort_array({values})', 'v', _let(starts, 'starts', runs))})"


def compared(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the fingerprint of the text column and what is compared of it: all ``anchors`` and all ``links``."""
    found = df.withColumn("found_a", anchors(text)).withColumn("found_v", F.expr("transform(found_a, x -> shiftright(x.hash, 32))"))
    links = "transform(found_v, (x, i) -> xxhash64(x, get(found_v, i + 1), get(found_a, i + 1).place - found_a[i].place))"
    found = found.withColumn("found_l", F.expr(links))
    return found.select(*df.columns, F.expr("array_join(transform(found_v, x -> cast(x as string)), ' ')").alias(f"{prefix}fingerprint"),
                        F.expr(_counted("found_v")).alias(f"{prefix}anchors"), F.expr(_counted("found_l")).alias(f"{prefix}links"))


def likeness(a: str, b: str, of: str = "anchors") -> Column:
    """Share of anchors (or ``of`` links) in common of two compared texts, 2c / (a + b)."""
    x, y = a + of, b + of
    return F.expr(f"2D * size(array_intersect({x}, {y})) / (size({x}) + size({y}))")


def with_next(docs: DataFrame) -> DataFrame:
    """Every document as ``compared``, with the same of the next one by id (after the last: the first).

    Ids are cut into ranges of about ``RANGE_ROWS`` rows (at most
    ``MAX_RANGES``, of more rows then) at approximate quantiles. An id that
    alone has the rows of two ranges has ranges of its own, cut evenly by the
    hash that orders its rows; there are at most ``MAX_RANGES`` such ids. A
    range is one window's partition; the first row of a range also goes, as a
    guest, to the range before it, so that the last row there has its next one
    (with it come rows that have the same id and text; the first of them counts).
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("y"))
    n = docs.select("doc_id").count()
    rows_each = max(RANGE_ROWS, math.ceil(n / MAX_RANGES))
    ranges = max(1, math.ceil(n / rows_each))
    bounds, hot = set(), []
    if ranges > 1:
        shares = [j / ranges for j in range(1, ranges)]
        bounds = set(d.agg(F.percentile_approx("k", shares, max(10_000, 20 * ranges))).first()[0])
        hot = d.groupBy("k").count().where(F.col("count") >= 2 * rows_each).collect()  # at most MAX_RANGES / 2 ids
        bounds |= {b for r in hot for b in (r.k, r.k + 1) if b < 1 << 63}
    sub = F.lit(0)
    if hot:
        d = stored(d.withColumn("nr", F.monotonically_increasing_id()), "next-documents")
        parts = docs.sparkSession.createDataFrame([(r.k, math.ceil(r["count"] / rows_each)) for r in hot], "k long, parts int")
        even = F.expr("cast(least(parts - 1, floor((cast(y as double) / 18446744073709551616D + 0.5D) * parts)) as int)")
        d = d.join(F.broadcast(parts), "k", "left").withColumn("y", F.when(F.col("parts").isNotNull(), F.xxhash64("nr")).otherwise(F.col("y")))
        sub = F.coalesce(even, F.lit(0))
    d = d.withColumn("bucket", _bucket(sorted(bounds))).withColumn("sub", sub)
    # one row for each range: its first row, and the range before (before the first: the last)
    firsts = d.groupBy("bucket", "sub").agg(F.min(F.struct("k", "y")).alias("first"))
    firsts = firsts.select("first.k", "first.y", F.struct("bucket", "sub").alias("own"))
    before = F.lag("own").over(Window.orderBy("own"))
    last = F.max("own").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select("k", "y", F.coalesce(before, last).alias("host"))
    columns = ["doc_id", "text", "k", "y"]
    guests = d.select(columns).join(F.broadcast(firsts), ["k", "y"]) \
        .select(*columns, F.col("host.bucket").alias("bucket"), F.col("host.sub").alias("sub"), F.lit(True).alias("guest"))
    rows = d.select(*columns, "bucket", "sub", F.lit(False).alias("guest")).unionByName(guests)
    rows = compared(rows.repartition("bucket", "sub"))
    order = Window.partitionBy("bucket", "sub").orderBy("guest", "k", "y")
    return rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", *COMPARED)}) \
        .where("not guest").drop("guest", "bucket", "sub", "k", "y")


def _bucket(bounds: list[int], step: int = 128) -> Column:
    """Number of bounds up to ``k``, found in two steps."""
    if not bounds:
        return F.lit(0)
    listed = lambda xs: "array(" + ", ".join(f"{x}L" if x > -(1 << 63) else "-9223372036854775808L" for x in xs) + ")"
    coarse = f"size(filter({listed(bounds[step - 1::step])}, b -> b <= k))" if len(bounds) >= step else "0"
    return F.expr(f"{_let(coarse, 'c', f'c * {step} + size(filter(slice({listed(bounds)}, c * {step} + 1, {step}), b -> b <= k))')}")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last half is replaced by the next document's beginning, likenesses and positional matches."""
    half = F.expr("char_length(text) div 2").cast("int")
    d = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half)))
    d = compared(d.drop("text", "next_text"), "edited", "edited_").withColumn("edited_sha256", F.sha2("edited", 256))
    return d.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness("", "edited_").alias("near_edited"), likeness("", "next_").alias("near_next"),
                    likeness("", "edited_", "links").alias("match_edited"), likeness("", "next_", "links").alias("match_next"))


def all_anchors(docs: DataFrame) -> DataFrame:
    """doc_id, and all anchors (place, hash) of every document."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", anchors("text").alias("anchors"))
