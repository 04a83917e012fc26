"""Mixing sources to target weights by hierarchical budgets.

A tree of levels (domain, language, source) carries whole-number weights. The token budget goes down
the tree: the children of a node share its budget by weight, a child that cannot use its share
(its documents, read at most `epochs` times) passes the rest to its siblings, and only what a whole
family cannot use reaches the families beside it. Every leaf then reads its documents in seeded
order, whole epochs first and a prefix of the next one.

All of it is native: one narrow pass counts tokens, the tree is as large as the number of leaves,
and the prefix is found as a limit on the seeded order, first by buckets and then within one bucket,
so a leaf with a third of all rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import (
    WORD,
    const_rows,
    join_small,
    materialize,
    query,
    table,
    unsigned_part,
)

BUCKET_ROWS = 4096   # rows of a leaf that one task orders
ORDER_DIGITS = 15    # hexadecimal digits of the seeded order: 60 bits
MISSING = "(none)"
# The domains are ranges of the source number, weights are whole numbers, 1 if unnamed.
DOMAINS = [(0, 9, "web"), (10, 14, "books"), (15, 19, "forums")]
WEIGHTS = [{"web": 6, "books": 3, "forums": 2}, {"en": 4}, {}]
SEED, EPOCHS = 42, 2


def seeded_order(seed: int, epoch: Column, key: Column) -> Column:
    """60 bits of a digest of seed, epoch and key; SQL engines agree on it."""
    said = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                       F.coalesce(key.cast("string"), F.lit("")))
    return unsigned_part(F.md5(said.cast("binary")), 1, ORDER_DIGITS)


def domain_of(source: str) -> Column:
    number = F.regexp_extract(F.col(source), r"^src([0-9]{1,6})$", 1).try_cast("int")
    found = F.lit("other")
    for low, high, name in DOMAINS:
        found = F.when(number.between(low, high), F.lit(name)).otherwise(found)
    return found


def _wide(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def split_budget(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Share each parent's `given` among its children by `weight`, none above its `room`.

    Children are taken by room per weight. A child is full if its room is within its share of what
    the fuller ones left; from the first that is not, the rest is shared by weight, rounded down.
    """
    family = Window.partitionBy(*parents)
    line = family.orderBy(F.col("room") / F.col("weight"), "name")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.select(
        "*", F.row_number().over(line).alias("place"),
        (F.col("given") - F.coalesce(F.sum("room").over(before), F.lit(0))).alias("rest"),
        F.sum("weight").over(after).alias("weights"))
    open_ = _wide(F.col("room")) * _wide(F.col("weights")) > (
        _wide(F.col("weight")) * _wide(F.col("rest")))
    nodes = nodes.withColumn("first_open", F.min(
        F.when(open_, F.struct("place", "rest", "weights"))).over(family))
    return nodes.withColumn("budget", F.expr(
        "CASE WHEN first_open IS NULL OR place < first_open.place THEN room ELSE CAST("
        "(CAST(weight AS decimal(19,0)) * CAST(first_open.rest AS decimal(19,0))) "
        "DIV first_open.weights AS long) END")
    ).drop("place", "rest", "weights", "first_open")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]],
                 budget: int | None, epochs: int) -> DataFrame:
    """`leaves` (levels, docs, tokens) with `budget`; without a budget, all tokens are shared."""
    spark = leaves.sparkSession
    nodes = leaves.select(*levels, "docs", "tokens", (F.col("tokens") * epochs).alias("room"))
    total = F.lit(budget).cast("long") if budget is not None else nodes.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long")).scalar()
    given = None
    for i, level in enumerate(levels):
        known = const_rows(spark, list(weights[i].items()), "name string, weight long")
        rows = nodes.groupBy(*levels[:i + 1]).agg(F.sum("room").alias("room")).withColumn(
            "name", F.col(level))
        rows = rows.join(known, "name", "left").withColumn(
            "weight", F.coalesce("weight", F.lit(1).cast("long")))
        if given is None:
            rows = rows.withColumn("given", total).withColumn("all", F.lit(0))
            shared = split_budget(rows, ["all"])
        else:
            shared = split_budget(rows.join(given, levels[:i]), levels[:i])
        given = shared.select(*levels[:i + 1], F.col("budget").alias("given"))
    return nodes.join(given, levels).select(*levels, "docs", "tokens",
                                            F.col("given").alias("budget"))


def mix_sources(docs: DataFrame, levels: dict[str, Column], weights: list[dict[str, int]],
                key: str = "doc_id", text: str = "text", budget: int | None = None,
                epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents of the mix: struct `doc` (the input row), the levels, `epoch` (from 0),
    `leaf_budget` and `leaf_tokens`; a document comes once per epoch that takes it.

    Tokens are whitespace words. A leaf takes its documents in the order of a digest of seed, epoch
    and key while the tokens before are below its budget, so the last one may go over it. Rows with
    equal keys stand at one place and are taken together. A null level is a leaf of its own, named
    "(none)"; a null key is an empty one; a null text has no tokens. A leaf without any token
    takes nothing. No rows give no rows. Input columns stay inside `doc`, so names cannot clash.
    Repeated rows are taken each. A very long text counts all its words; where it starts below a
    leaf's budget it is taken whole.
    """
    names = list(levels)
    placed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("key"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long")
                   ).alias("n"),
        *[F.coalesce(c.cast("string"), F.lit(MISSING)).alias(n) for n, c in levels.items()])
    narrow = materialize(placed.select("key", "n", *names), "tokens")
    leaves = narrow.groupBy(*names).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens"))
    leaves = materialize(leaf_budgets(leaves, names, weights, budget, epochs).withColumns({
        "whole": F.expr("CASE WHEN tokens > 0 THEN budget DIV tokens ELSE 0 END").cast("int"),
        "rest": F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0),
        "buckets": F.expr(f"1 + docs DIV {BUCKET_ROWS}")}), "leaves")
    # The place at which the prefix of each leaf's last epoch ends.
    at = seeded_order(seed, F.col("whole"), F.col("key"))
    cut = join_small(narrow, leaves, names).where("rest > 0").withColumn("at", at).withColumn(
        "bucket", F.shiftright(F.shiftright("at", 20) * F.col("buckets"), 40))
    sums = cut.groupBy(*names, "bucket").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*names).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("before", before).join(
        leaves.select(*names, "rest"), names).where("before < rest").groupBy(*names).agg(
        F.max(F.struct("bucket", "before")).alias("end")).select(
        *names, F.col("end.bucket").alias("bucket"), "end.before")
    within = join_small(cut, materialize(ends, "ends"), [*names, "bucket"]).groupBy(*names, "at", "rest", "before").agg(
        F.sum("n").alias("n"))
    taken = F.coalesce(F.sum("n").over(Window.partitionBy(*names).orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)) + F.col("before")
    last = within.withColumn("taken", taken).where("taken < rest").groupBy(*names).agg(
        F.max("at").alias("last"))
    plan = materialize(leaves.join(last, names, "left").select(
        *names, "tokens", "budget", "whole", F.coalesce("last", F.lit(-1)).alias("last")), "plan")
    reads = F.col("whole") + F.when(at <= F.col("last"), 1).otherwise(0)
    return join_small(placed.drop("n"), plan, names).withColumn("reads", reads).where("reads > 0").select(
        "doc", *names, F.explode(F.sequence(F.lit(0), F.col("reads") - 1)).alias("epoch"),
        F.col("budget").alias("leaf_budget"), F.col("tokens").alias("leaf_tokens"))


def corpus_levels() -> dict[str, Column]:
    return {"domain": domain_of("source"), "of_lang": F.col("lang"), "of_source": F.col("source")}


def _shares_sql(level: str, parents: str, parent_table: str, on: str, weights: dict[str, int]) -> str:
    """One level of the tree in SQL: tables n_, o_ and b_ for nodes, their order, budgets."""
    cases = "".join(f" WHEN '{n}' THEN {w}" for n, w in weights.items())
    weight = f"CASE {level}{cases} ELSE 1 END" if cases else "1"
    keys = f"{parents}{level}"
    family = f"PARTITION BY {parents.rstrip(', ')}" if parents else ""
    return f"""
n_{level} AS (
  SELECT {keys}, sum(room) AS room, {weight}::HUGEINT AS weight FROM leaves GROUP BY {keys}),
o_{level} AS (
  SELECT n.*, given, row_number() OVER w AS place,
    given - coalesce(sum(room) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM n_{level} n JOIN {parent_table} {on}
  WINDOW w AS ({family} ORDER BY room::DOUBLE / weight::DOUBLE, {level})),
b_{level} AS (
  SELECT {keys}, CASE WHEN first IS NULL OR place < first.place THEN room
    ELSE weight * first.rest // first.weights END AS given
  FROM (SELECT *, min(CASE WHEN room * weights > weight * rest THEN
      {{'place': place, 'rest': rest, 'weights': weights}} END) OVER ({family}) AS first
    FROM o_{level})),"""


def mixing_sql(docs: str, columns: str) -> str:
    """The mix in SQL over a table of documents that has a row number `rn`."""
    ranges = " ".join(f"WHEN num BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in DOMAINS)
    order = (f"('0x' || substr(md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), 1, "
             f"{ORDER_DIGITS}))::BIGINT")
    levels = ["domain", "of_lang", "of_source"]
    return f"""
base AS (
  SELECT *, CASE {ranges} ELSE 'other' END AS domain, coalesce(lang, '{MISSING}') AS of_lang,
    coalesce(source, '{MISSING}') AS of_source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n
  FROM (SELECT *, TRY_CAST(regexp_extract(source, '^src([0-9]{{1,6}})$', 1) AS INT) AS num
        FROM {docs})),
leaves AS (
  SELECT domain, of_lang, of_source, sum(n)::HUGEINT AS tokens, {EPOCHS} * sum(n)::HUGEINT AS room
  FROM base GROUP BY ALL),
total AS (SELECT sum(tokens) AS given FROM leaves),
{_shares_sql(levels[0], "", "total", "ON true", WEIGHTS[0])}
{_shares_sql(levels[1], "domain, ", "b_domain", "USING (domain)", WEIGHTS[1])}
{_shares_sql(levels[2], "domain, of_lang, ", "b_of_lang", "USING (domain, of_lang)", WEIGHTS[2])}
plan AS (
  SELECT l.domain, l.of_lang, l.of_source, tokens, given,
    CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
  FROM leaves l JOIN b_of_source USING (domain, of_lang, of_source)),
placed AS (
  SELECT base.*, given, tokens, whole, rest, {order} AS ord
  FROM base JOIN plan USING (domain, of_lang, of_source)),
prefix AS (
  SELECT domain, of_lang, of_source, ord, sum(sum(n)) OVER (
    PARTITION BY domain, of_lang, of_source ORDER BY ord) - sum(n) AS taken
  FROM placed GROUP BY domain, of_lang, of_source, ord),
mixed AS (
  SELECT * FROM (
    SELECT p.*, unnest(range(0, (whole + CASE WHEN taken < rest THEN 1 ELSE 0 END)::BIGINT)) AS epoch
    FROM placed p JOIN prefix USING (domain, of_lang, of_source, ord)))
SELECT {columns} FROM mixed"""


@query("op4_mixing", "WITH " + mixing_sql(
    "documents", "doc_id, domain, of_lang, of_source, epoch::INT AS epoch, "
    "given::BIGINT AS leaf_budget, tokens::BIGINT AS leaf_tokens"))
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix_sources(docs, corpus_levels(), WEIGHTS).select(
        "doc.doc_id", "domain", "of_lang", "of_source", "epoch", "leaf_budget", "leaf_tokens")
