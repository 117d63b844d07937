"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Sizes are words. Sources, by code point with null last, weigh ``weights`` in turn and share all
words; a target stops at ``most_repeats`` times its source's words, and the excess is shared
again by weight until no target is above. The solution is target = min(cap, level x weight):
sources in the order of cap / weight, prefix sums of their caps and weights, and the first
level that the next source's ratio does not undercut. Prefix sums over the sources run in
buckets of consecutive sources, then over the buckets, so no task holds all of them.

Within a source every document expects the same number of copies, target / words. Documents
stand in the order of their size (then of a hash of their id), one random offset is added,
and a document is emitted once for each whole number that the running sum of expected
copies crosses at it. As neighbours are of like size, the words taken differ from the
target by about one document's size at most. The offset is the best of ``OFFSETS`` evenly
spaced ones from a random start: the one whose words come nearest to the target. Expected
copies are whole multiples of 2^-20 and sums are exact, so no document has more than
``most_repeats`` copies and reruns agree.
The running sum is (rank x copies): ranks come from one distributed sort with an offset
for each partition, so a source of any size is spread over all tasks.

Defined cases: a null or empty text has size 0 and may be taken (it adds nothing). A source
without words has target 0. The null source is a source. Repeated rows stand next to each
other and are sampled each on its own; rows that tie in (size, id) are alike. A null doc_id
is kept. An empty table gives an empty result. Other columns are kept by ``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.numbering import number_rows
from tastegraph.llm.common import running_sums, words_of, written

UNIT = 20  # expected copies are multiples of 2^-20
OFFSETS = 32


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_repeats: int = 3) -> DataFrame:
    """sources (source, words) plus ``target``: words wanted of each."""
    numbered = number_rows(sources, [F.col("source").isNull(), F.col("source")], "_n")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_n") % len(weights)).cast("int") + 1)
    capped = numbered.select("source", "words", weight.cast("long").alias("w"),
                             (F.col("words") * most_repeats).alias("cap"))
    # cap / weight as a whole number: weights divide their least common multiple
    common = 1
    for w in weights:
        a, b = common, w
        while b:
            a, b = b, a % b
        common = common // a * w
    ratio = F.col("cap") * (F.lit(common) / F.col("w")).cast("long")
    running = running_sums(capped, [ratio, F.col("source").isNull(), F.col("source")],
                       {"caps": F.col("cap").cast("decimal(38,0)"), "ws": F.col("w")}, "_r")
    running = written(running, "mix-sources")
    all_words, all_w = (running.agg(F.sum(c)).scalar() for c in ("words", "w"))
    # with the sources up to here at their caps, the others share the rest at this level
    left = (all_w - F.col("ws") + F.col("w")).cast("double")
    rest = (all_words - F.col("caps") + F.col("cap")).cast("double")
    level = running.withColumn("level", rest / left)
    # the first source whose cap is not below its share at the level of those before it
    fits = level.filter(F.col("cap").cast("double") >= F.col("level") * F.col("w"))
    final = fits.agg(F.min(F.struct("_r", "level")).alias("m")).select("m.level").scalar()
    cap = F.col("cap").cast("double")
    return running.select("source", "words", F.coalesce(F.least(cap, final * F.col("w")), cap).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_repeats: int = 3, seed: int = 11,
        carry: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every row (``carry`` adds columns)."""
    carry = carry or []
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                                words_of("text").alias("size"), *carry), "mix-sizes")
    sources = written(sized.groupBy("source").agg(F.sum("size").alias("words")), "mix-words")
    targets = source_targets(sources, weights, most_repeats)
    # copies expected of each document, and the first offset, as whole multiples of 2^-UNIT
    each = F.when(F.col("words") > 0, F.least(
        F.round(F.col("target") / F.col("words") * F.lit(float(1 << UNIT))).cast("long"),
        F.lit(most_repeats << UNIT))).otherwise(F.lit(0)).cast("long")
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("-"))).cast("binary")),
                               1, UNIT // 4), 16, 10).cast("long")  # UNIT bits of a digest
    deal = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary"))
    ranked = number_rows(sized, [F.col("source"), F.col("size"), deal, F.col("doc_id"), *[F.col(c) for c in carry]],
                         "_place")
    firsts = ranked.groupBy("source").agg(F.min("_place").alias("_first"))
    plan = (targets.join(firsts, targets["source"].eqNullSafe(firsts["source"])).drop(firsts["source"])
            .select(F.col("source").alias("_source"), F.col("words").alias("source_size"), "target", "_first",
                    each.alias("_each"), start.alias("_start")))
    placed = ranked.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    rank = F.col("_place") - F.col("_first")  # times _each: exact up to 10^12 documents in a source
    crossed = lambda n, offset: F.shiftright(n * F.col("_each") + offset, UNIT)
    copies = lambda offset: crossed(rank + 1, offset) - crossed(rank, offset)
    offsets = [F.pmod(F.col("_start") + F.lit(k * (1 << UNIT) // OFFSETS), F.lit(1 << UNIT)) for k in range(OFFSETS)]
    tried = placed.groupBy("_source").agg(
        F.first("target").alias("_target"), F.first("_start").alias("_start"),
        *[F.sum(copies(o) * F.col("size")).alias(f"_t{k}") for k, o in enumerate(offsets)])
    best = tried.select(F.col("_source").alias("_of"), F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"_t{k}") - F.col("_target")).alias("miss"), o.alias("offset"))
        for k, o in enumerate(offsets)]))["offset"].alias("_offset"))
    return (placed.join(best, F.col("_source").eqNullSafe(F.col("_of")))
            .select("doc_id", "source", "size", "source_size", "target", copies(F.col("_offset")).alias("copies"),
                    *carry))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with docs' columns. Rows equal
    in every column are alike, so their copies are given out together."""
    key, copies, n, of = (_free(docs, x) for x in ("_key", "_copies", "_n", "_of"))
    hashed = docs.withColumn(key, F.xxhash64(*docs.columns))
    plan = (mix(hashed, carry=[key]).groupBy(F.col("doc_id").alias(of), key)
            .agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(n)).filter(F.col(copies) > 0))
    taken = hashed.join(plan, (hashed[key] == plan[key]) & hashed["doc_id"].cast("long").eqNullSafe(plan[of])) \
        .drop(plan[key])
    single = taken.filter(F.col(n) == 1)
    alike = taken.filter(F.col(n) > 1).dropDuplicates([of, key])
    return (single.unionByName(alike).withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*docs.columns))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not use."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS words FROM sized GROUP BY source),
capped AS (
  SELECT source, words, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, words * 3 AS cap FROM sources),
running AS (
  SELECT *, row_number() OVER o AS r, sum(cap) OVER o - cap AS caps, sum(w) OVER () - (sum(w) OVER o - w) AS left_w,
         sum(words) OVER () AS all_words
  FROM capped WINDOW o AS (ORDER BY cap * 10 // w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (all_words - caps)::DOUBLE / left_w::DOUBLE AS level FROM running),
final AS (SELECT min_by(level, r) AS level FROM levels WHERE cap::DOUBLE >= level * w),
targets AS (
  SELECT source, words, coalesce(least(cap::DOUBLE, f.level * w), cap::DOUBLE) AS target
  FROM running, final f),
plan AS (
  SELECT *, CASE WHEN words > 0 THEN least(round(target / words * 1048576.0)::BIGINT, 3145728) ELSE 0 END AS rate,
         ('0x' || substr(md5('11:' || coalesce(source, '-')), 1, 5))::BIGINT AS start
  FROM targets),
placed AS (
  SELECT s.doc_id, s.size, p.source, p.words, p.target, p.rate, p.start,
         row_number() OVER (PARTITION BY p.source
                            ORDER BY s.size, md5('11:' || coalesce(s.doc_id::VARCHAR, '-')), s.doc_id) - 1 AS k
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
tried AS (
  SELECT p.source, any_value(p.target) AS target, o.k AS try, (any_value(p.start) + o.k * 32768) % 1048576 AS first,
         sum((((p.k + 1) * p.rate + (p.start + o.k * 32768) % 1048576) // 1048576
              - (p.k * p.rate + (p.start + o.k * 32768) % 1048576) // 1048576) * p.size) AS got
  FROM placed p, (SELECT unnest(range(32)) AS k) o GROUP BY p.source, o.k),
best AS (
  SELECT source, min(struct_pack(miss := abs(got - target), first := first)).first AS first FROM tried GROUP BY source)
SELECT p.doc_id, p.size, p.words AS source_size, p.target,
       ((((p.k + 1) * p.rate + b.first) // 1048576 - (p.k * p.rate + b.first) // 1048576) * p.size)::BIGINT AS taken,
       (((p.k + 1) * p.rate + b.first) // 1048576 - (p.k * p.rate + b.first) // 1048576)::BIGINT AS copies
FROM placed p JOIN best b ON p.source IS NOT DISTINCT FROM b.source
"""
