"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources in order of code point (null last) weigh 5, 2, 1, repeating.  Their
targets share the corpus' words by weight; a target stops at ``EPOCHS`` times
its source's size and the excess is shared anew by weight among the others.
The corpus' words make blocks of ``BLOCK`` words; the blocks go to the sources
by the highest quotients target / (2 i + 1), and a source's blocks go to its
shards (dealt by a hash of the id) by the same rule on the shards' sizes.  A
source has the corpus' number of shards, which grows with the corpus, or fewer
so that a shard holds ``SHARD_LEAST`` of its words on average.  A shard's documents stand in a seeded
order, end to end; its quota is the first so many blocks of that line, which
starts again at its end (whole passes, then a part) and ends with its pass
EPOCHS, so no document is taken more often; the words that a quota has beyond
that end go to the source's other shards, by what is left of their lines.

All of it is DataFrame work: the documents are read twice (sizes, which are
written and added up by source and shard, then the takes), meet the short table of sources and are shuffled once,
by source and shard; a hot source is split over its shards.

Defined results: a null text has size 0 and is not taken; a null source is a
source; a null id has a place like any other; repeated rows count each; an
empty table gives an empty result.  Columns beyond those named are not read,
but for the ones to carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import materialize, words_regex

WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Words of a block.
BLOCK = 16
#: Words of all sources that a shard number should hold; from MANY shards on they
#: may hold more, up to SHARD_MOST.  Shards are a power of two, without an upper end.
SHARD_WORDS, MANY, SHARD_MOST = 1 << 18, 4096, 1 << 24
#: Shard numbers are taken from so many bits.
NUMBER_BITS = 32
#: Words of its source that a shard holds on average, at least.
SHARD_LEAST = 64 * BLOCK
SEED = "mix"


def _quotas(df: DataFrame, share: Column, seats: Column, number: str, whole: list[str], order: list[str]) -> DataFrame:
    """``number``: so many of ``seats`` blocks as the highest quotients
    share / (2 i + 1) give each row, within each group of the columns ``whole``.

    Rounding each share at the common divisor is the same rule's result for a
    nearby number of seats; the seats that differ are then given to the
    highest next quotients or taken from the lowest last ones.  Rounding at the
    divisor for half a seat a row more (less) gives (leaves) at least (most) the
    seats asked for, so the quotients between the two divisors hold all that can
    be given (taken); they are the difference and one a row, at most, and
    each row offers one more against rounding errors."""
    group = Window.partitionBy(*whole) if whole else Window.partitionBy(F.lit(0))
    df = df.withColumn("share_", share).withColumn("seats_", seats).withColumn("all_", F.sum("share_").over(group))
    df = df.withColumn("first_", F.when(F.col("all_") > 0, F.floor(F.col("seats_") * F.col("share_") / F.col("all_") + 0.5)).otherwise(0))
    df = df.withColumn("lack_", F.col("seats_") - F.sum("first_").over(group))
    half = F.signum("lack_") * F.sum((F.col("share_") > 0).cast("long")).over(group) / 2
    near = F.when(F.col("all_") > 0, F.floor(F.greatest(F.col("seats_") + half, F.lit(0)) * F.col("share_") / F.col("all_") + 0.5)).otherwise(0)
    df = df.withColumn("steps_", F.least(F.abs("lack_"), F.abs(near - F.col("first_")) + 1))
    at = F.when(F.col("lack_") > 0, F.col("first_") + F.col("i_") - 1).otherwise(F.col("first_") - F.col("i_"))
    quotient = F.col("share_") / (2 * F.col("at_") + 1)
    tried = (df.where("lack_ <> 0 and share_ > 0").withColumn("i_", F.explode(F.sequence(F.lit(1), F.col("steps_").cast("int")))).withColumn("at_", at).where("at_ >= 0")
             .withColumn("rank_", F.row_number().over(group.orderBy(F.when(F.col("lack_") > 0, -quotient).otherwise(quotient), *order)))
             .where("rank_ <= abs(lack_)").groupBy(*[F.col(c).alias(f"{c}_k") for c in order]).agg(F.sum(F.signum("lack_")).cast("long").alias("more_")))
    same = F.lit(True)
    for c in order:
        same = same & (F.col(c) == F.col(f"{c}_k"))
    out = df.join(tried, same, "left").withColumn(number, F.col("first_") + F.coalesce("more_", F.lit(0)))
    return out.drop("share_", "seats_", "all_", "first_", "lack_", "steps_", "more_", *[f"{c}_k" for c in order])


def _passed_on(parts: DataFrame) -> DataFrame:
    """``take``: each shard's words after the cut, and of the words that its
    source's shards lost by it a part like its share of the room, to the word."""
    whole = Window.partitionBy("source_")
    left = F.least(F.col("blocks") * BLOCK, EPOCHS * F.col("source_size")) - F.sum("cut").over(whole)
    parts = parts.withColumn("left_", left.cast("decimal(19,0)")).withColumn("rooms_", F.sum("room").over(whole))
    parts = parts.withColumn("upto_", F.sum("room").over(whole.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    more = F.expr("left_ * cast(upto_ as decimal(19,0)) div rooms_ - left_ * cast(upto_ - room as decimal(19,0)) div rooms_")
    return parts.withColumn("take", F.col("cut") + F.when(F.col("rooms_") > 0, more).otherwise(0)).drop("left_", "rooms_", "upto_")


def _key(col: str) -> Column:
    return F.when(F.col(col).isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.col(col)))


def _hex(name: str) -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}:{name}:"), F.coalesce(F.col("id_").cast("string"), F.lit("null"))))


def _number(hexed: Column) -> Column:
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")


def corpus_shards(words: int) -> int:
    """Shards of a source that holds many words, in a corpus of ``words``."""
    n = 1
    while n < 1 << (NUMBER_BITS - 1) and (n < MANY and n * SHARD_WORDS < words or n * SHARD_MOST < words):
        n *= 2
    return n


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col`` and the carried columns with ``size``, ``source_size``,
    ``target`` and ``taken`` (words that the mix takes, repeats counted) of every row."""
    sized = docs.select(F.col(id_col).alias("id_"), _key(source_col).alias("source_"), *[F.col(c).alias(f"carry_{c}") for c in carry],
                        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(words_regex)).cast("long").alias("size"))
    sized = sized.withColumn("number_", _number(_hex("shard")))
    sizes, _ = materialize(sized.select("source_", "number_", "size"), "mixsizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = corpus_shards(total)
    # sizes by source and finest shard: sources x shards rows at most
    fine, _ = materialize(sizes.groupBy("source_", (F.col("number_") % shards).alias("fine")).agg(F.sum("size").alias("words")), "mixshards")

    one = Window.partitionBy(F.lit(0))
    sources = fine.groupBy("source_").agg(F.sum("words").alias("source_size"))
    sources = sources.withColumn("place", F.row_number().over(one.orderBy(F.col("source_") == "~", "source_")))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") - 1) % len(WEIGHTS) + 1))
    # the level at which targets = weight * level, stopped at the most of each source, share all words
    sources = sources.withColumn("most", EPOCHS * F.col("source_size")).withColumn("until", F.col("most") / F.col("weight"))
    up = one.orderBy("until", "place")
    before = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    sources = sources.withColumn("level", (F.lit(total) - before) / left)
    sources = sources.withColumn("target", F.least(F.col("most").cast("double"), F.max("level").over(one) * F.col("weight")))
    sources = _quotas(sources, F.col("target"), F.floor(F.lit(total) / BLOCK + 0.5), "blocks", [], ["place"])

    few = F.array_max(F.filter(F.array(*[F.lit(1 << i) for i in range(shards.bit_length())]), lambda n: (n == 1) | (n * SHARD_LEAST <= F.col("source_size"))))
    sources, _ = materialize(sources.select("source_", "place", "source_size", "target", "blocks", few.alias("shards")), "mixsources")

    parts = fine.join(sources, "source_").groupBy("source_", "place", "source_size", "target", "blocks", (F.col("fine") % F.col("shards")).alias("shard")).agg(F.sum("words").alias("words"))
    parts = _quotas(parts, F.col("words").cast("double"), F.col("blocks"), "quota", ["place"], ["place", "shard"])
    parts = _passed_on(parts.withColumn("cut", F.least(F.col("quota") * BLOCK, EPOCHS * F.col("words"))).withColumn("room", EPOCHS * F.col("words") - F.col("cut")))
    parts, _ = materialize(parts.select("source_", "shard", "words", "source_size", "target", "take"), "mixquotas")

    line = Window.partitionBy("source_", "shard").orderBy(_hex("order"), "id_", "size")
    got = sized.join(sources.select("source_", "shards"), "source_").withColumn("shard", F.col("number_") % F.col("shards")).drop("shards").join(parts, ["source_", "shard"])
    got = got.withColumn("end_", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    part = F.least(F.greatest(F.expr("take % words") - (F.col("end_") - F.col("size")), F.lit(0)), F.col("size"))
    taken = F.when(F.col("words") > 0, F.expr("take div words") * F.col("size") + part).otherwise(0).cast("long")
    return got.select(F.col("id_").alias(id_col), *[F.col(f"carry_{c}").alias(c) for c in carry], "size", "source_size", "target", taken.alias("taken"))


def sql() -> str:
    """DuckDB SQL for the rows of ``mixed`` on ``documents``."""
    return rf"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS skey,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, 'null')) AS line_key,
    ('0x' || substr(md5('{SEED}:shard:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS num
  FROM documents),
total AS (SELECT coalesce(sum(size), 0)::BIGINT AS t FROM sized),
powers AS (SELECT 1::BIGINT << i AS v FROM range(0, {NUMBER_BITS}) AS p(i)),
shards AS (SELECT t, (SELECT min(v) FROM powers WHERE v = 1::BIGINT << {NUMBER_BITS - 1} OR (v >= {MANY} OR v * {SHARD_WORDS} >= t) AND v * {SHARD_MOST} >= t) AS n FROM total),
src0 AS (SELECT skey, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY skey = '~', skey) AS place FROM sized GROUP BY skey),
src1 AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight, {EPOCHS} * source_size AS most FROM src0),
src2 AS (SELECT *, (t - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY most::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM src1, total),
src3 AS (SELECT *, least(most::DOUBLE, max(level) OVER () * weight) AS target, floor(t::DOUBLE / {BLOCK} + 0.5)::BIGINT AS seats FROM src2),
src4 AS (SELECT *, CASE WHEN sum(target) OVER () > 0 THEN floor(seats * target / sum(target) OVER () + 0.5)::BIGINT ELSE 0 END AS first FROM src3),
src5 AS (SELECT *, (seats - sum(first) OVER ())::BIGINT AS lack FROM src4),
srcq AS (SELECT place, sign(lack)::BIGINT AS s, row_number() OVER (ORDER BY CASE WHEN lack > 0 THEN -(target / (2 * k + 1)) ELSE target / (2 * k + 1) END, place) AS r, lack
  FROM (SELECT place, lack, target, CASE WHEN lack > 0 THEN first + i - 1 ELSE first - i END AS k
        FROM (SELECT *, unnest(range(1, abs(lack) + 1)) AS i FROM src5 WHERE lack <> 0 AND target > 0)) WHERE k >= 0),
src AS (SELECT skey, src5.place, source_size, target, first + coalesce(more, 0) AS blocks,
    (SELECT max(v) FROM powers, shards WHERE v <= n AND (v = 1 OR v * {SHARD_LEAST} <= source_size)) AS parts
  FROM src5 LEFT JOIN (SELECT place, sum(s)::BIGINT AS more FROM srcq WHERE r <= abs(lack) GROUP BY place) m ON m.place = src5.place),
part0 AS (SELECT sized.skey, num % parts AS shard, sum(size)::BIGINT AS words FROM sized JOIN src ON src.skey = sized.skey GROUP BY ALL),
part1 AS (SELECT part0.*, place, source_size, target, blocks, sum(words) OVER (PARTITION BY place) AS whole FROM part0 JOIN src USING (skey)),
part2 AS (SELECT *, CASE WHEN whole > 0 THEN floor(blocks * words::DOUBLE / whole::DOUBLE + 0.5)::BIGINT ELSE 0 END AS first FROM part1),
part3 AS (SELECT *, (blocks - sum(first) OVER (PARTITION BY place))::BIGINT AS lack FROM part2),
partq AS (SELECT place, shard, sign(lack)::BIGINT AS s, lack,
    row_number() OVER (PARTITION BY place ORDER BY CASE WHEN lack > 0 THEN -(words::DOUBLE / (2 * k + 1)) ELSE words::DOUBLE / (2 * k + 1) END, place, shard) AS r
  FROM (SELECT place, shard, lack, words, CASE WHEN lack > 0 THEN first + i - 1 ELSE first - i END AS k
        FROM (SELECT *, unnest(range(1, abs(lack) + 1)) AS i FROM part3 WHERE lack <> 0 AND words > 0)) WHERE k >= 0),
cuts AS (SELECT skey, part3.place, part3.shard, words, source_size, target, blocks, least((first + coalesce(more, 0)) * {BLOCK}, {EPOCHS} * words) AS cut
  FROM part3 LEFT JOIN (SELECT place, shard, sum(s)::BIGINT AS more FROM partq WHERE r <= abs(lack) GROUP BY ALL) m ON m.place = part3.place AND m.shard = part3.shard),
rooms AS (SELECT *, {EPOCHS} * words - cut AS room, (least(blocks * {BLOCK}, {EPOCHS} * source_size) - sum(cut) OVER (PARTITION BY place))::HUGEINT AS rest,
    (sum({EPOCHS} * words - cut) OVER (PARTITION BY place))::HUGEINT AS rooms,
    (sum({EPOCHS} * words - cut) OVER (PARTITION BY place ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::HUGEINT AS upto FROM cuts),
part AS (SELECT skey, shard, words, source_size, target,
    (cut + CASE WHEN rooms > 0 THEN rest * upto // rooms - rest * (upto - room) // rooms ELSE 0 END)::BIGINT AS take FROM rooms),
line AS (SELECT doc_id, size, part.source_size, part.target, words, take,
    sum(size) OVER (PARTITION BY sized.skey, num % parts ORDER BY line_key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ended
  FROM sized JOIN src ON src.skey = sized.skey JOIN part ON part.skey = sized.skey AND part.shard = num % parts)
SELECT doc_id, size, source_size, target,
  CASE WHEN words > 0 THEN (take // words) * size + least(greatest(take % words - (ended - size), 0), size) ELSE 0 END::BIGINT AS taken
FROM line"""

