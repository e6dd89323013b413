"""Temperature mixing: source shares raised to one exponent, weights realised as budgeted permutations of blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmart.llm.common import WORD, settle

_PROBES = 15  # exponents tried per job: each job narrows the interval sixteen times
_STEPS = 8


@dataclass(frozen=True)
class Settings:
    """The mix asked for.

    The budget is `budget` times the tokens there are. Weights are shares to the
    power of the exponent, 1 keeping the shares and 0 making sources equal. The
    exponent is the largest up to 1 whose weights have `min_entropy` of the
    highest possible entropy, but at least so large that no source is repeated
    more than `max_repeats` times on average; 1 if nothing else can do that.
    Either may be None. A source has a block per `block_tokens` tokens, at most
    `max_blocks`; beyond that its blocks grow.
    """

    budget: float = 1.0
    min_entropy: float | None = 0.97
    max_repeats: float | None = 2.0
    block_tokens: int = 100_000
    max_blocks: int = 1 << 16
    seed: int = 17


def word_count(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _hex(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def _key(source: str) -> Column:
    """The source as a text that is never null, with null apart from every source."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def exponent(totals: DataFrame, s: Settings) -> float:
    """The exponent for totals (tokens per source), by bisection; probes of a step are columns of one aggregate."""
    whole, n = totals.agg(F.sum("total"), F.count("*")).first()
    if not n or n == 1:
        return 1.0
    share = F.col("total") / F.lit(float(whole))

    def probe(exponents: list[float], of) -> list[float]:
        return list(totals.agg(*[of(e).alias(f"_{i}") for i, e in enumerate(exponents)]).first())

    def entropy(e: float) -> Column:
        w = F.pow(share, F.lit(e))
        return (F.log(F.sum(w)) - F.sum(w * F.log(w)) / F.sum(w)) / F.log(F.count("*").cast("double"))

    def repeats(e: float) -> Column:
        return F.max(F.pow(share, F.lit(e)) / share) / F.sum(F.pow(share, F.lit(e))) * s.budget

    def search(of, good_at_zero) -> float:
        """The place in 0 to 1 where `of` changes; it falls with the exponent and `good_at_zero` tells the side."""
        low, high = 0.0, 1.0
        for _ in range(_STEPS):
            tried = [low + (high - low) * i / (_PROBES + 1) for i in range(1, _PROBES + 1)]
            left = sum(good_at_zero(v) for v in probe(tried, of))
            ends = [low, *tried, high]
            low, high = ends[left], ends[left + 1]
        return (low + high) / 2

    found = 1.0
    if s.min_entropy is not None and probe([1.0], entropy)[0] < s.min_entropy:
        found = search(entropy, lambda v: v >= s.min_entropy)
    elif s.min_entropy is None:
        found = 0.0
    if s.max_repeats is not None and probe([found], repeats)[0] > s.max_repeats:
        limit = max(s.max_repeats, s.budget)  # the shares themselves repeat every source `budget` times
        found = search(repeats, lambda v: v > limit)
    return round(found, 6)


def weights(totals: DataFrame, s: Settings) -> DataFrame:
    """Per source with tokens (key, total): its weight, its budget in tokens, its number of blocks."""
    known = totals.where("total > 0")
    e = exponent(known, s)
    whole = known.agg(F.sum("total")).first()[0] or 0
    power = F.pow(F.col("total") / F.lit(float(max(whole, 1))), F.lit(e))
    norm = known.agg(F.sum(power)).first()[0] or 1.0
    weight = F.round(power / F.lit(norm), 9)
    blocks = F.least(F.ceil(F.col("total") / s.block_tokens), F.lit(s.max_blocks))
    return known.select(
        "key", "total", weight.alias("weight"),
        F.floor(weight * F.lit(whole) * s.budget + 0.5).cast("long").alias("quota"),
        blocks.cast("long").alias("blocks"),
    )


def mix(docs: DataFrame, tokens: str, source: str = "source", doc_id: str = "doc_id", s: Settings = Settings()) -> DataFrame:
    """Rows of `docs`, each as often as the mix takes it, with `epoch`, `block`, `start` and `weight`.

    A source whose budget is a number of passes and a rest gives every row once
    per pass, and of one more pass the first blocks of that pass's permutation
    until the rest is used up; of the block in which it ends, rows in permuted
    order as far as their tokens fit. So a source falls short of its budget by
    less than one row. `start` in 0 to 1 is where a block begins in its source's
    budget: ordered by it, sources alternate in the mix's proportions.

    A null source is a source of its own. A source without tokens takes no
    part. Texts without tokens are taken along. Repeated rows are taken each for
    itself. The result has the columns of `docs`; one that is named like a new
    one is replaced by it.

    Sources only meet their own totals. Blocks are spread by a hash of the id,
    so a source with a third of all rows is as many tasks as it has blocks; one
    window sees the at most `max_blocks` blocks of a source, another the rows of
    the one block in which its budget ends.
    """
    own = docs.columns
    inner = [f"_{i}" for i in range(len(own))]
    tokens, source, doc_id = (f"_{own.index(c)}" for c in (tokens, source, doc_id))
    keyed = docs.toDF(*inner).withColumn("key", _key(source))
    shares = settle(weights(settle(keyed.groupBy("key").agg(F.sum(tokens).alias("total")), "mix-totals"), s), "mix-weights")
    digits = F.conv(F.substring(_hex(F.lit(s.seed), F.lit("block"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8), 16, 10)
    placed = keyed.join(shares.select("key", "blocks", "weight"), "key").withColumn("block", F.pmod(digits.cast("long"), F.col("blocks")))
    sums = placed.groupBy("key", "block").agg(F.sum(tokens).alias("size"))
    turn = Window.partitionBy("key", "epoch").orderBy(_hex(F.lit(s.seed), F.col("key"), F.col("epoch"), F.col("block")), "block")
    passes = F.floor(F.col("quota") / F.col("total")).cast("long")
    rest = F.col("quota") - passes * F.col("total")
    order = (
        sums.join(shares.select("key", "quota", "total"), "key")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), passes.cast("int"))))
        .withColumn("before", F.sum("size").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("left", F.when(F.col("epoch") < passes, F.col("size")).otherwise(rest - F.col("before")))
        .where("left > 0")
        .select("key", "block", "epoch", ((F.col("epoch") * F.col("total") + F.col("before")) / F.col("quota")).alias("start"), "left",
                (F.col("left") >= F.col("size")).alias("whole"))
    )
    order = settle(order, "mix-order")
    taken = placed.join(order.where("whole").drop("whole", "left"), ["key", "block"])
    within = Window.partitionBy("key", "block", "epoch").orderBy(
        _hex(F.lit(s.seed), F.col("epoch"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.col(doc_id), F.col(tokens)
    )
    ends = (
        placed.join(order.where("not whole").drop("whole"), ["key", "block"])
        .withColumn("used", F.sum(tokens).over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("used") <= F.col("left"))
    )
    new = ["epoch", "block", "start", "weight"]
    kept = [(a, b) for a, b in zip(inner, own) if b.lower() not in new]
    both = taken.select(*inner, *new).unionByName(ends.select(*inner, *new))
    return both.select(*[F.col(a).alias(b) for a, b in kept], *new)


def oracle(s: Settings) -> str:
    """The mix of `documents` by words as DuckDB SQL."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens,
         coalesce('=' || source, '') AS key
  FROM documents
), totals AS (
  SELECT key, CAST(sum(tokens) AS BIGINT) AS total FROM d GROUP BY key HAVING sum(tokens) > 0
), p AS (
  SELECT key, total, total / CAST((SELECT sum(total) FROM totals) AS DOUBLE) AS share FROM totals
), search_entropy AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1,
         CASE WHEN h >= {s.min_entropy} THEN middle ELSE low END,
         CASE WHEN h >= {s.min_entropy} THEN high ELSE middle END
  FROM (SELECT step, low, high, (low + high) / 2 AS middle,
               (SELECT (ln(sum(pow(share, (low + high) / 2)))
                        - sum(pow(share, (low + high) / 2) * ln(pow(share, (low + high) / 2))) / sum(pow(share, (low + high) / 2)))
                       / ln(count(*)) FROM p) AS h
        FROM search_entropy WHERE step < 40)
), search_repeats AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1,
         CASE WHEN r > {max(s.max_repeats, s.budget)} THEN middle ELSE low END,
         CASE WHEN r > {max(s.max_repeats, s.budget)} THEN high ELSE middle END
  FROM (SELECT step, low, high, (low + high) / 2 AS middle,
               (SELECT max(pow(share, (low + high) / 2) / share) / sum(pow(share, (low + high) / 2)) * {s.budget} FROM p) AS r
        FROM search_repeats WHERE step < 40)
), first_choice AS (
  SELECT CASE WHEN (SELECT count(*) FROM p) < 2
                OR (SELECT -sum(share * ln(share)) / ln(count(*)) FROM p) >= {s.min_entropy} THEN 1.0
              ELSE (SELECT (low + high) / 2 FROM search_entropy WHERE step = 40) END AS e
), chosen AS (
  SELECT round(CASE WHEN (SELECT count(*) FROM p) < 2 THEN 1.0
                    WHEN (SELECT max(pow(share, e) / share) / sum(pow(share, e)) * {s.budget} FROM p) > {s.max_repeats}
                    THEN (SELECT (low + high) / 2 FROM search_repeats WHERE step = 40) ELSE e END, 6) AS e
  FROM first_choice
), w AS (
  SELECT key, total, round(pow(share, e) / (SELECT sum(pow(share, e)) FROM p, chosen), 9) AS weight FROM p, chosen
), plan AS (
  SELECT key, total, weight,
         CAST(floor(weight * (SELECT sum(total) FROM totals) * {s.budget} + 0.5) AS BIGINT) AS quota,
         CAST(least(ceil(total / {s.block_tokens}), {s.max_blocks}) AS BIGINT) AS blocks
  FROM w
), placed AS (
  SELECT d.*, weight, CAST('0x' || substr(md5('{s.seed}:block:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % blocks AS block
  FROM d JOIN plan USING (key)
), epochs AS (
  SELECT s.key, s.block, s.size, quota, total, e.epoch, quota // total AS passes
  FROM (SELECT key, block, CAST(sum(tokens) AS BIGINT) AS size FROM placed GROUP BY key, block) s JOIN plan USING (key),
       LATERAL (SELECT unnest(range(quota // total + 1)) AS epoch) e
), filled AS (
  SELECT *, sum(size) OVER (PARTITION BY key, epoch ORDER BY md5('{s.seed}:' || key || ':' || epoch || ':' || block), block
                            ROWS UNBOUNDED PRECEDING) - size AS before FROM epochs
), blocks_taken AS (
  SELECT *, CASE WHEN epoch < passes THEN size ELSE quota - passes * total - before END AS left_over FROM filled
), copies AS (
  SELECT doc_id, p.source, tokens, b.epoch, p.block, (b.epoch * b.total + b.before) / CAST(b.quota AS DOUBLE) AS start, weight, left_over, b.size,
         sum(tokens) OVER (PARTITION BY p.key, p.block, b.epoch
                           ORDER BY md5('{s.seed}:' || b.epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, tokens
                           ROWS UNBOUNDED PRECEDING) AS used
  FROM placed p JOIN blocks_taken b ON p.key = b.key AND p.block = b.block
  WHERE left_over > 0
)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block AS BIGINT) AS block, start, weight
FROM copies WHERE left_over >= size OR used <= left_over
"""
