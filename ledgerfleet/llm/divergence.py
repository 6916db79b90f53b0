"""Source divergence audit: how far the word use of sources lies apart.

For every language the terms in at least ``MIN_DOCS`` of its documents are kept.
Each (language, source) group, and each language, gives every kept term an integer rate
``1 + floor(SCALE * (count + 2) / (N + 2 * V))``; two groups differ by the sum of
``floor((p - q)**2 / (p + q))`` over all kept terms of the language.

The sums are made by three-dimensional cube partitioning.  The groups of a
language are cut into blocks of ``GROUP_BLOCK``, its kept terms into blocks of about
``TERM_BLOCK`` by a hash.  A task owns a cell (group block, group block, term block):
it receives the two slices (group block, term block) it needs, each replicated
to as many cells as the language has group blocks, and returns the partial sum
of every pair of its groups; the partial sums are then added along the term axis.
A cell holds at most 2 x GROUP_BLOCK groups and one block of terms, whatever the
size of the corpus, of a source or of a language.  Terms that no group of a cell
uses have the same two rates throughout: a cell says how many terms it has covered
and the rest is added as a product after the reduction, so the sum runs over all kept
terms.

Counts are folded in the task that reads the texts, then by Spark map-side, so a
source with a third of all documents sends no more rows than it has terms.
All arithmetic is in integers; counts are widened to 38 digits where a product
could leave 64 bits.

Hard cases: null text, lang and source are empty strings; an empty text is a
document without terms; repeated rows are documents of their own; a group without
kept terms has the rate of count 0 everywhere; a language without kept terms
gives its pairs with value 0 and no terms; ties are ranked by the UTF-8 bytes
of the item.  An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, map_batches, materialize

# --- fixed values: the contract's terms, rates and thresholds -------------------
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
SCALE = 1_000_000_000
PRIOR = 2
TOP_TERMS = 10
# ---------------------------------------------------------------------------------
GROUP_BLOCK = 32
TERM_BLOCK = 8192
# Distinct (group, term) entries a counting task holds before it hands them on.
HELD_TERMS = 400_000

COUNTS = "lang string, source string, term string, n long, docs long"


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), folded in the task.
    Every group also gives a row without a term, so that it is known even if
    none of its documents has one."""
    find = re.compile(TERM).findall
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            seen = docs[lang, source]
            words = [None, *terms]
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(words, pa.string()),
                 pa.array([0, *terms.values()], pa.int64()), pa.array([0, *(seen[t] for t in terms)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        columns = batch.to_pydict()
        for text, lang, source in zip(columns["text"], columns["lang"], columns["source"]):
            group = (lang or "", source or "")
            of_group, of_docs = counts[group], docs[group]
            held -= len(of_group)
            own = Counter(find((text or "").translate(ASCII_LOWER)))
            of_group.update(own)
            of_docs.update(own.keys())
            held += len(of_group)
            if held >= HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all documents; the row without a
    term stands for the group itself."""
    partial = map_batches(docs.select("text", "lang", "source"), _count_terms, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The terms in at least ``min_docs`` documents of their language, per
    source that uses them, with the language's count (``lang_n``).  The rows
    without a term stay.  A window partition holds one row per source."""
    of_term = Window.partitionBy("lang", "term")
    wide = counts.select("lang", "source", "term", "n", F.sum("docs").over(of_term).alias("lang_docs"),
                         F.sum("n").over(of_term).alias("lang_n"))
    return (wide.where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
            .select("lang", "source", "term", "n", "lang_n"))


def rate(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kinds)), exactly."""
    top = (n + PRIOR).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + PRIOR * kinds).cast("decimal(20,0)")
    # integral division of decimals is exact and truncates; both are positive
    return (F.call_function("div", top, bottom) + 1).cast("long")


def spread(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); rates stay below 2**30, the square in 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups_of(kept: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """One row per (lang, source): ``total`` of its counts, the language's
    ``kinds`` (V) and ``lang_total``, its number and block, the number of
    group and term blocks of the language, and its rate of an unused term."""
    own = kept.groupBy("lang", "source").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    # a term stands once per source that uses it; distinct first, then counted
    kinds = (kept.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total")))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    many = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    g = (own.withColumn("gid", number).withColumn("of_lang", many).join(kinds, "lang", "left")
         .withColumn("kinds", F.coalesce("kinds", F.lit(0))).withColumn("lang_total", F.coalesce("lang_total", F.lit(0))))
    return g.select(
        "lang", "source", "gid", "total", "kinds", "lang_total", F.floor(F.col("gid") / group_block).cast("int").alias("block"),
        F.ceil(F.col("of_lang") / group_block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("kinds") / term_block), F.lit(1)).cast("int").alias("term_blocks"),
        F.when(F.col("kinds") > 0, rate(F.lit(0).cast("long"), F.col("total"), F.col("kinds"))).alias("unused"))


CELL = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("part", pa.int64()),
                  ("covered", pa.int64())])


def _cell(table: pa.Table) -> pa.Table:
    """One cell: the partial sums of all pairs of its groups over its terms."""
    lang, left_block, right_block = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
    gid, block, p = (table.column(c).to_numpy() for c in ("gid", "block", "p"))
    words = table.column("term").combine_chunks().dictionary_encode()
    code = words.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    terms = len(words.dictionary)

    def slice_of(b: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the block's groups and their rates of the cell's terms."""
        heads = (block == b) & (code < 0)
        order = np.argsort(gid[heads])
        ids, unused = gid[heads][order], p[heads][order]
        rates = np.repeat(unused[:, None], terms, axis=1)
        used = (block == b) & (code >= 0)
        rates[np.searchsorted(ids, gid[used]), code[used]] = p[used]
        return ids, rates

    left_ids, left = slice_of(left_block)
    right_ids, right = (left_ids, left) if left_block == right_block else slice_of(right_block)
    rows = []
    for a in range(len(left_ids)):
        others = slice(a + 1 if left_block == right_block else 0, None)
        apart = left[a] - right[others]
        sums = ((apart * apart) // (left[a] + right[others])).sum(axis=1)
        rows += zip([int(left_ids[a])] * len(sums), right_ids[others].tolist(), sums.tolist())
    g, h, part = zip(*rows) if rows else ((), (), ())
    return pa.Table.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int32()), pa.array(h, pa.int32()),
                                 pa.array(part, pa.int64()), pa.array([terms] * len(g), pa.int64())], schema=CELL)


def pair_divergences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, value) with g < h, the numbers of two groups of a language:
    the cells of the cube, then the sum along the term axis."""
    place = groups.select("lang", "source", "gid", "block", "blocks", "term_blocks", "total", "kinds", "unused")
    used = (kept.where(F.col("term").isNotNull()).join(place, ["lang", "source"])
            .select("lang", "gid", "block", "blocks", "term", rate(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
                    F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t")))
    # every group stands in every slice of its language, used there or not
    heads = place.select("lang", "gid", "block", "blocks", F.lit(None).cast("string").alias("term"),
                         F.coalesce("unused", F.lit(1).cast("long")).alias("p"),
                         F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t"))
    slices = used.unionByName(heads)
    cells = (slices.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "t", "gid", "block",
                     "term", "p"))
    partial = cells.groupBy("lang", "i", "j", "t").applyInArrow(
        _cell, "lang string, g int, h int, part long, covered long")
    summed = partial.groupBy("lang", "g", "h").agg(F.sum("part").alias("part"), F.sum("covered").alias("covered"))
    rest = [groups.select(F.col("lang"), F.col("gid").alias(side), F.col("source").alias(f"{side}_source"),
                          F.col("unused").alias(f"{side}_unused"), "kinds") for side in ("g", "h")]
    both = summed.join(rest[0], ["lang", "g"]).join(rest[1].drop("kinds"), ["lang", "h"])
    unseen = F.when(F.col("kinds") > F.col("covered"),
                    (F.col("kinds") - F.col("covered")) * spread(F.col("g_unused"), F.col("h_unused"))).otherwise(0)
    return both.select("lang", "g_source", "h_source", (F.col("part") + unseen).cast("long").alias("value"))


def term_excess(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group uses more than its
    language does, furthest first."""
    place = groups.select("lang", "source", "total", "kinds", "lang_total")
    rated = (kept.where(F.col("term").isNotNull() & (F.col("n") > 0)).join(place, ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"), rate(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
                     rate(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q")))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (rated.where(F.col("p") > F.col("q")).select("lang", "source", "item", spread(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, group_block: int = GROUP_BLOCK,
          term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other
    sources of the language by their divergence from the source, part ``term``
    its most excessive terms."""
    kept = materialize(kept_terms(term_counts(docs), min_docs), "divergence-terms")
    groups = materialize(groups_of(kept, group_block, term_block), "divergence-groups")
    pairs = pair_divergences(kept, groups)
    sides = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("g_source").alias("source"), F.col("h_source").alias("item")),
        F.struct(F.col("h_source").alias("source"), F.col("g_source").alias("item")))).alias("s"), "value")
    of_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = sides.select("lang", "s.source", "s.item", "value").withColumn("rank", F.row_number().over(of_group))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked.withColumn("part", F.lit("pair")).select(columns)
            .unionByName(term_excess(kept, groups).withColumn("part", F.lit("term")).select(columns)))
