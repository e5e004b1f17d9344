"""Mixing sources to target weights by hierarchical budgets.

Leaves are (domain, language, source). A budget of tokens is shared from the root down: each child
gets its part by weight, at most what its leaves can give in ``max_epochs`` passes. What a child
cannot use goes to its siblings by weight; only what a whole family cannot use stays with the
parent's siblings, because a subtree is never given more than it can take. All shares are integers.

Each leaf then takes its documents: whole epochs first, and of the last epoch the documents whose
running token count, in the seeded order of that epoch, stays within the rest. Running counts come in
two steps, over 4096 ranges of the order and within the range where the budget ends, so no task
holds a leaf.

Only DataFrame functions are used. Defined cases: null text or language or source count as the empty
string, documents without tokens are never taken, a source without number has domain "other",
unlisted weights are ``DEFAULT_WEIGHT``, rows that repeat each other are taken one by one, an empty
table gives no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parceltide.llm import common

DEFAULT_WEIGHT = 10
CELL_DIGITS = 3  # hex digits of the key that name a range of the order: 4096 ranges
LEVELS = ("domain", "leaf_lang", "leaf_source")


@dataclass(frozen=True)
class Mix:
    """Target weights per level and the size of the mix. ``budget_percent`` is of all tokens."""

    domain: dict[str, int] = field(default_factory=lambda: {"d0": 40, "d1": 30, "d2": 20, "d3": 10})
    leaf_lang: dict[str, int] = field(default_factory=lambda: {"en": 50, "de": 20, "fr": 20, "es": 10})
    leaf_source: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 60
    max_epochs: int = 3
    seed: int = 7


def leaves(docs: DataFrame) -> DataFrame:
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    number = F.regexp_extract(source, r"^[^0-9]*([0-9]{1,9})$", 1)
    # The sources of the tables are numbered; their number stands for a domain.
    domain = F.when(number == "", "other").otherwise(
        F.concat(F.lit("d"), F.pmod(number.cast("bigint"), F.lit(4)).cast("string")))
    return docs.withColumns({
        "domain": domain, "leaf_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "leaf_source": source,
        "n_tokens": F.expr(r"regexp_count(coalesce(cast(text AS string), ''), '[^\\x20\\x09-\\x0D]+')").cast("bigint"),
    })


def _weight(level: str, weights: dict[str, int]) -> Column:
    value = F.lit(DEFAULT_WEIGHT)
    for name, weight in weights.items():
        value = F.when(F.col(level) == name, weight).otherwise(value)
    return value.cast("bigint")


def _share(children: DataFrame, level: str, family: list[str], weights: dict[str, int]) -> DataFrame:
    """Water filling of ``parent_budget`` over the children of each family by weight and capacity.
    Children are taken by capacity per weight; those that the level of the rest covers are full."""
    whole = Window.partitionBy(*(family or [F.lit(0)]))
    ordered = whole.orderBy(F.col("capacity") / F.col("w").cast("double"), level)
    rows = children.withColumn("w", _weight(level, weights)).withColumns({
        "rest": F.col("parent_budget") - F.coalesce(F.sum("capacity").over(
            ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest_weight": F.sum("w").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    }).withColumn("full", F.expr(
        "cast(rest AS decimal(20,0)) * cast(w AS decimal(18,0)) >= "
        "cast(capacity AS decimal(20,0)) * cast(rest_weight AS decimal(18,0))"))
    # All that follow the first child that is not full share what is left there. Weights are
    # positive, so that child has the largest rest of weights.
    return rows.withColumn(
        "open", F.max(F.when(~F.col("full"), F.struct("rest_weight", "rest"))).over(whole)
    ).withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr(
        "(cast(open.rest AS decimal(20,0)) * cast(w AS decimal(18,0))) div open.rest_weight")).cast("bigint")
    ).drop("w", "rest", "rest_weight", "full", "open")


def budgets(sized: DataFrame, mix: Mix) -> DataFrame:
    """(leaf, supply, budget) from (leaf, supply): the tree from the root down."""
    capacity = sized.withColumn("capacity", F.col("supply") * mix.max_epochs)
    total = capacity.agg(F.floor(F.sum("supply") * mix.budget_percent / 100).cast("bigint")).first()[0]
    shared = None
    for i, level in enumerate(LEVELS):
        keys, family = list(LEVELS[: i + 1]), list(LEVELS[:i])
        rows = capacity.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        rows = rows.withColumn("parent_budget", F.lit(total).cast("bigint")) if shared is None else rows.join(
            shared.select(*family, F.col("budget").alias("parent_budget")), family)
        shared = _share(rows, level, family, getattr(mix, level))
    return sized.join(shared.select(*LEVELS, "budget"), list(LEVELS))


def _key(epoch: Column, seed: int) -> Column:
    """The place of a document in the seeded order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_md5"))


def digest(docs: DataFrame) -> DataFrame:
    """What the plan needs of each document: no texts."""
    return leaves(docs.select("doc_id", "text", "lang", "source")).withColumn(
        "text_md5", F.md5(common.text_or_empty())).select("doc_id", *LEVELS, "n_tokens", "text_md5")


def plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: supply, budget, whole epochs, and the last key taken of the epoch after them."""
    sized = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply")).filter("supply > 0")
    shares = common.written(
        budgets(common.written(sized, "mix-supply"), mix).withColumns({
            "epochs": F.expr("budget div supply"), "rest": F.expr("budget % supply")}), "mix-budget")
    keyed = rows.filter("n_tokens > 0").join(shares, list(LEVELS)).select(
        *LEVELS, "n_tokens", "rest", _key(F.col("epochs"), mix.seed).alias("key")
    ).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    leaf = Window.partitionBy(*LEVELS)
    # The range of keys in which the rest ends.
    cells = keyed.groupBy(*LEVELS, "cell", "rest").agg(F.sum("n_tokens").alias("n")).withColumn(
        "upto", F.sum("n").over(leaf.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    border = cells.filter("upto > rest").groupBy(*LEVELS).agg(
        F.min(F.struct("cell", (F.col("upto") - F.col("n")).alias("before"))).alias("border")
    ).select(*LEVELS, F.col("border.cell").alias("cell"), F.col("border.before").alias("before"))
    border = common.written(border, "mix-border")
    # Equal keys are peers: a range frame takes them together.
    running = F.sum("n_tokens").over(leaf.orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cut = keyed.join(border, [*LEVELS, "cell"]).withColumn("running", F.col("before") + running).filter(
        "running <= rest").groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    return common.written(shares.join(border.drop("before"), list(LEVELS), "left").join(
        cut, list(LEVELS), "left").select(
            *LEVELS, "supply", "budget", "epochs", "cell",
            F.coalesce("cut", F.lit("")).alias("cut")), "mix-plan")


def take(rows: DataFrame, leaf_plan: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` with ``copies``: how often each is taken; rows not taken are left out."""
    key = _key(F.col("epochs"), mix.seed)
    in_prefix = (F.substring(key, 1, CELL_DIGITS) < F.col("cell")) | (key <= F.col("cut"))
    return rows.join(leaf_plan, list(LEVELS)).withColumn(
        "copies", (F.col("epochs") + F.when(in_prefix, 1).otherwise(0)).cast("bigint")
    ).filter((F.col("copies") > 0) & (F.col("n_tokens") > 0)).drop(
        "supply", "budget", "epochs", "cell", "cut")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    rows = common.written(digest(docs), "mix-digest")
    return take(rows, plan(rows, mix), mix).drop("text_md5")


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """The taken documents themselves, with the columns of ``docs``, once per copy."""
    leaf_plan = plan(common.written(digest(docs), "mix-digest"), mix)
    names, rows = docs.columns, common.by_position(docs, "doc_id", "text", "lang", "source")
    taken = take(leaves(rows).withColumn("text_md5", F.md5(common.text_or_empty())), leaf_plan, mix)
    return taken.withColumn("copy_no", F.explode(F.expr("sequence(1L, copies)"))).select(
        *[F.col(f"_own_{i}") for i in range(len(names))]).toDF(*names)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(common.table(spark, sf_dir, "documents"))


def _oracle(mix: Mix) -> str:
    """The same mix by plain window functions."""

    def case(level: str) -> str:
        arms = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in getattr(mix, level).items())
        return f"CASE{arms} ELSE {DEFAULT_WEIGHT} END" if arms else str(DEFAULT_WEIGHT)

    sql = rf"""WITH src AS (
  SELECT doc_id, coalesce(lang, '') AS leaf_lang, coalesce(source, '') AS leaf_source,
    CASE WHEN regexp_extract(coalesce(source, ''), '^[^0-9]*([0-9]{{1,9}})$', 1) = '' THEN 'other'
      ELSE 'd' || (regexp_extract(coalesce(source, ''), '^[^0-9]*([0-9]{{1,9}})$', 1)::BIGINT % 4) END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n_tokens,
    md5(coalesce(text, '')) AS text_md5
  FROM documents),
sized AS (SELECT domain, leaf_lang, leaf_source, sum(n_tokens)::BIGINT AS supply FROM src
  GROUP BY ALL HAVING sum(n_tokens) > 0),
b0 AS (SELECT (floor(sum(supply) * {mix.budget_percent} / 100))::BIGINT AS budget FROM sized)"""
    for i, level in enumerate(LEVELS):
        keys, family = ", ".join(LEVELS[: i + 1]), LEVELS[:i]
        part = f"PARTITION BY {', '.join(family)}" if family else ""
        using = f"JOIN b{i} USING ({', '.join(family)})" if family else "CROSS JOIN b0"
        sql += f""",
c{i} AS (SELECT g.*, b{i}.budget AS parent_budget, {case(level)} AS w FROM (
    SELECT {keys}, sum(supply)::BIGINT * {mix.max_epochs} AS capacity FROM sized GROUP BY {keys}) g {using}),
r{i} AS (SELECT *,
    (parent_budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / w::DOUBLE, {level}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS rest,
    (sum(w) OVER ({part} ORDER BY capacity / w::DOUBLE, {level}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rest_weight FROM c{i}),
f{i} AS (SELECT *, rest * w >= capacity::HUGEINT * rest_weight AS is_full FROM r{i}),
o{i} AS (SELECT *, max(CASE WHEN NOT is_full THEN rest_weight END) OVER ({part}) AS open_weight,
    max(CASE WHEN NOT is_full THEN rest END) OVER ({part}) AS open_rest FROM f{i}),
b{i + 1} AS (SELECT {keys}, (CASE WHEN is_full THEN capacity ELSE (open_rest * w) // open_weight END)::BIGINT
    AS budget FROM o{i})"""
    names = ", ".join(LEVELS)
    return sql + f""",
k AS (SELECT src.*, budget // supply AS epochs, budget % supply AS rest,
    md5(concat_ws(':', '{mix.seed}', (budget // supply)::VARCHAR, coalesce(doc_id::VARCHAR, ''), text_md5)) AS key
  FROM src JOIN sized USING ({names}) JOIN b{len(LEVELS)} USING ({names}) WHERE n_tokens > 0),
t AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {names} ORDER BY key
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM k)
SELECT doc_id, {names}, n_tokens, (epochs + CASE WHEN running <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM t WHERE epochs > 0 OR running <= rest"""


ORACLE_SQL = _oracle(Mix())
