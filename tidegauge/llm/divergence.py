"""Source divergence audit: how the term shares of each (language, source) group
differ from those of its language and of the language's other sources.

A term is a run of ASCII letters and non-ASCII characters, ASCII capitals lowered.
A language keeps the terms of at least ``MIN_DOCS`` of its documents. A group or
language gives a kept term the share ``1 + floor(10^9 (count + 1) / (N + V))``, with
N its occurrences of the V kept terms; a share p diverges from a share q by
``f = floor((p - q)^2 / q)``. All arithmetic is on whole numbers.

Count-cell ranking: shares depend on counts alone, so f is evaluated per cell of
(group count, language count), not per term.

1. Texts become counts per (language, source, term) in Arrow batches, summed before
   and after one shuffle; a window per (language, term) adds the language's count
   and drops terms of too few documents. Only this table is read from here on.
2. ``term``: cells with their number of terms get f; equal values merge; the best
   ``TOP`` values of a group, with the running sum of their multiplicities, say which
   cells hold the ranks to ``TOP``. Only these are expanded into terms, in UTF-8
   order, from each cell's first ``TOP`` terms.
3. ``pair``: terms with the same counts in all sources are one vector. Vectors deal
   out cells (count in one source, count in another) of the terms that both have;
   cells of terms that one or neither has follow from each source's own cells:

       sum f = sum over shared cells of  f(a, b) - f(a, 0) - f(0, b) + f(0, 0)
             + sum over a's cells f(a, 0)  +  sum over b's cells f(0, b)
             + (V - terms of a - terms of b) f(0, 0)

No task holds more than a batch of texts, one term's sources, or ``TOP`` terms of a
cell; a hot source is summed before each shuffle. The number of sources of a
language shows up squared, as in the result.

Edge cases: null text, language or source count as ''. Groups without terms take
part, with count 0 of each term. A language that keeps no term has value 0 in all
pairs and no ``term`` rows; a group that is alone has no pairs. Equal rows are
documents of their own. An empty table gives an empty result. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.shared import written
from tidegauge.llm.text_batches import pieces, plain_texts, words_of

MIN_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
BATCH = 4 << 20

_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[0x41:0x5B] = _IS_TERM[0x61:0x7B] = _IS_TERM[0x80:] = True

COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of each batch; a row without a
    term for each group, so that groups without terms are known."""
    for batch in batches:
        for piece in pieces(batch, "text", BATCH):
            langs, sources = (piece.column(c).dictionary_encode() for c in ("lang", "source"))
            groups = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            words = words_of(plain_texts(piece.column("text")), _IS_TERM)
            lowered = pc.ascii_lower(words.vocabulary.cast(pa.large_string())).dictionary_encode()
            codes = lowered.indices.to_numpy().astype(np.int64)[words.codes]
            kinds = max(1, len(lowered.dictionary))
            text = np.repeat(np.arange(piece.num_rows), np.diff(words.bounds))
            once, n = np.unique(text * kinds + codes, return_counts=True)
            cells, cell = np.unique(groups[once // kinds] * kinds + once % kinds, return_inverse=True)
            known = np.unique(groups)
            group = np.concatenate([cells // kinds, known])
            terms = lowered.dictionary.take(pa.array(cells % kinds)).cast(pa.string())
            zeros = np.zeros(len(known), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(group // len(sources.dictionary))),
                    sources.dictionary.take(pa.array(group % len(sources.dictionary))),
                    pa.concat_arrays([terms, pa.nulls(len(known), pa.string())]),
                    pa.array(np.concatenate([np.bincount(cell, n, len(cells)).astype(np.int64), zeros])),
                    pa.array(np.concatenate([np.bincount(cell, minlength=len(cells)), zeros])),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first): counts of kept terms in the groups that
    have them and in the language, ``first`` in one source of each term; and a row
    without a term for each group. Written to the shared folder."""
    texts = docs.select("text", *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
    counts = (
        texts.mapInArrow(_counted, COUNTED)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    everywhere = Window.partitionBy("lang", "term")
    held = counts.select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(everywhere).alias("total"),
        F.sum("docs").over(everywhere).alias("docs"),
        (F.col("source") == F.min("source").over(everywhere)).alias("first"),
    )
    return written(held.filter(F.col("term").isNull() | (F.col("docs") >= min_docs)).drop("docs"), "audit-counts")


def group_sizes(counts: DataFrame) -> DataFrame:
    """(lang, source, size, terms, lang_size, kinds): N and number of terms of the
    group, N and V of the language."""
    mine = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("term").alias("terms"))
    whole = counts.groupBy("lang").agg(
        F.sum("n").alias("lang_size"), F.count(F.when(F.col("first"), F.col("term"))).alias("kinds")
    )
    return written(mine.join(whole, "lang"), "audit-groups")


#: Counts below this times UNIT fit a bigint; larger ones are multiplied as decimals.
PLAIN = 9_000_000_000


def whole(column: Column, digits: int = 20) -> Column:
    return column.cast(f"decimal({digits},0)")


def share(count: Column, size: Column, kinds: Column) -> Column:
    plain = F.call_function("div", F.lit(UNIT) * (count + 1), size + kinds)
    large = F.call_function("div", F.lit(UNIT) * whole(count + 1), whole(size + kinds))
    return 1 + F.when(count < PLAIN, plain).otherwise(large)


def divergence(p: Column, q: Column) -> Column:
    """Shares are at most 10^9 + 1, so squares fit a bigint."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergent_terms(counts: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): terms of a share above the language's."""
    group, cell = ["lang", "source"], ["lang", "source", "n", "total"]
    terms = counts.filter("term IS NOT NULL")
    p, q = share(F.col("n"), F.col("size"), F.col("kinds")), share(F.col("total"), F.col("lang_size"), F.col("kinds"))
    cells = (
        terms.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("m"))
        .join(groups, group)
        .select(*cell, "m", p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select(*cell, "m", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    # Every value holds a term, so the ranks to top are within as many values.
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = cells.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    best = values.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= top)
    ahead = F.coalesce(F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = cells.join(best.select(*group, "value", ahead.alias("ahead")).filter(F.col("ahead") < top), [*group, "value"])
    in_cell = F.row_number().over(Window.partitionBy(*cell).orderBy("term"))
    few = terms.select(*cell, "term", in_cell.alias("place")).filter(F.col("place") <= top)
    in_value = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    return (
        few.join(wanted, cell)
        .withColumn("rank", F.col("ahead") + in_value)
        .filter(F.col("rank") <= top)
        .select(*group, F.col("term").alias("item"), "value", "rank")
    )


def shared_cells(counts: DataFrame) -> DataFrame:
    """(lang, a, b, na, nb, m): number of terms with count na in source a and nb in
    source b, for sources a < b that both have them."""
    vectors = (
        counts.filter("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"))
        .filter(F.size("vector") > 1)
        .groupBy("lang", "vector")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    one = vectors.select("lang", "m", "vector", F.posexplode("vector").alias("at", "one"))
    rest = F.slice("vector", F.col("at") + 2, F.size("vector"))
    two = one.select("lang", "m", "one", F.explode(rest).alias("two"))
    return two.groupBy(
        "lang",
        F.col("one.source").alias("a"),
        F.col("two.source").alias("b"),
        F.col("one.n").alias("na"),
        F.col("two.n").alias("nb"),
    ).agg(F.sum("m").alias("m"))


def divergent_sources(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each other source of the language."""

    def of(side: str) -> DataFrame:
        """A group, with its share ``zero`` of a term that it does not have."""
        size, kinds = F.col("size"), F.col("kinds")
        zero = F.when(kinds > 0, share(F.lit(0).cast("bigint"), size, kinds))
        return groups.select(
            "lang", F.col("source").alias(side), size.alias(f"size_{side}"), F.col("terms").alias(f"terms_{side}"),
            kinds.alias(f"kinds_{side}"), zero.alias(f"zero_{side}"),
        )

    def own_share(count: str, side: str) -> Column:
        return share(F.col(count), F.col(f"size_{side}"), F.col(f"kinds_{side}")).alias(f"p_{side}")

    def f(group: str, item: str) -> Column:
        return divergence(F.col(group), F.col(item))

    def both(rows: DataFrame, times: Column, value) -> DataFrame:
        """A row for each direction of the pair (a, b)."""

        def towards(x: str, y: str) -> Column:
            amount = whole(times, 18) * whole(value(x, y))
            return F.struct(F.col(x).alias("source"), F.col(y).alias("item"), amount.alias("value"))

        directions = F.explode(F.array(towards("a", "b"), towards("b", "a")))
        return rows.select("lang", directions.alias("v")).select("lang", "v.*")

    def of_shared(x: str, y: str) -> Column:
        return f(f"p_{x}", f"p_{y}") - f(f"p_{x}", f"zero_{y}") - f(f"zero_{x}", f"p_{y}") + f(f"zero_{x}", f"zero_{y}")

    def of_own(x: str, y: str) -> Column:
        # The cells are those of a: the group's counts one way, the item's the other.
        return f("p_a", "zero_b") if x == "a" else f("zero_b", "p_a")

    def of_rest(x: str, y: str) -> Column:
        return F.coalesce(f(f"zero_{x}", f"zero_{y}"), F.lit(0))

    shared = shared_cells(counts).join(of("a"), ["lang", "a"]).join(of("b"), ["lang", "b"])
    own = counts.filter("term IS NOT NULL").groupBy("lang", F.col("source").alias("a"), "n").agg(F.count(F.lit(1)).alias("m"))
    own = own.join(of("a"), ["lang", "a"]).select("lang", "a", "m", own_share("n", "a"))
    parts = [
        both(shared.select("*", own_share("na", "a"), own_share("nb", "b")), F.col("m"), of_shared),
        both(own.join(of("b"), "lang").filter("a <> b"), F.col("m"), of_own),
        both(of("a").join(of("b"), "lang").filter("a < b"), F.expr("kinds_a - terms_a - terms_b"), of_rest),
    ]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = term_counts(docs, min_docs)
    groups = group_sizes(counts)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = divergent_sources(counts, groups).withColumn("rank", F.row_number().over(ranked))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int"))

    return part(pairs, "pair").unionByName(part(divergent_terms(counts, groups, top), "term"))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
hits AS (SELECT lang, source, id, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM hits
  GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}
),
counts AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n
  FROM hits JOIN kept USING (lang, term) GROUP BY lang, source, term
),
groups AS (
  SELECT d.lang, d.source, coalesce(s.size, 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source) s USING (lang, source)
),
langs AS (SELECT lang, count(*) AS kinds, sum(total) AS size FROM kept GROUP BY lang),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 1)) // CAST(g.size + l.kinds AS HUGEINT) AS p,
         1 + (CAST({UNIT} AS HUGEINT) * (k.total + 1)) // CAST(l.size + l.kinds AS HUGEINT) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
term_rows AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM dense WHERE n > 0 AND p > q
),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
pair_rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM term_rows UNION ALL SELECT * FROM pair_rows)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
