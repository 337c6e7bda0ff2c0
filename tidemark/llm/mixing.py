"""Mixing sources to target weights over a tree of domain, language and source.

A token budget goes down the tree by weights. No node takes more than it has in the allowed number of epochs; what it
cannot take goes to its siblings by their weights, and only what the whole family cannot take reaches the siblings of
the parent. This is water filling within each family, in exact whole numbers, by running sums over the children in the
order of what they have for each unit of weight. A leaf takes whole epochs of its documents and, of the last epoch, the
longest prefix in a seeded order that stays within its budget.

Only Spark functions are used. A leaf's prefix is found by sums over 4,096 ranges of the order, then over as many of the one
range where the budget ends, until that one is small, and is applied as a bound on the order: no leaf is sorted, no
text is shuffled, and what one task sums does not grow with a leaf.

Null levels and weights count as "" and 0. A node of weight 0 takes nothing. Null and empty texts, and those of white
space, have no tokens and are not chosen. Rows that share an id have one place in the order and are chosen together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.joins import join_small_side, settled

#: Hex digits of the order by which ranges are cut at a time, and rows of a range that is not cut further.
RANGE_DIGITS, RANGE_ROWS = 3, 4096
PLACE_DIGITS = 32
_WIDE = "decimal(18,0)"


@dataclass(frozen=True)
class Level:
    """A level of the tree: its value in a document, and a node's weight (a whole number) by the columns of the levels."""

    name: str
    value: Column
    weight: Column


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def place(seed: int, epoch: Column, doc_id: str = "doc_id") -> Column:
    """A document's place in the order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def fill(nodes: DataFrame, family: Sequence[str], node: str) -> DataFrame:
    """Adds `budget` to nodes (family columns, node, weight, capacity, given): what each gets of its family's `given`."""
    own = Window.partitionBy(*family) if family else Window.partitionBy(F.lit(0))
    by_ratio = own.orderBy("__ratio", node)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: c.cast(_WIDE)
    rows = nodes.withColumn("__ratio", F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight")).otherwise(F.lit(float("inf"))))
    rows = rows.withColumn("__rank", F.row_number().over(by_ratio))
    rows = rows.withColumn("__taken", F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast("long"))
    rows = rows.withColumn("__lighter", F.coalesce(F.sum("weight").over(before), F.lit(0)).cast("long"))
    rows = rows.withColumn("__weights", F.sum("weight").over(own).cast("long") - F.col("__lighter"))
    rows = rows.withColumn("__left", F.col("given") - F.col("__taken"))
    full = (F.col("weight") > 0) & (wide(F.col("capacity")) * wide(F.col("__weights")) <= wide(F.col("__left")) * wide(F.col("weight")))
    rows = rows.withColumn("__open", F.min(F.when(~full, F.col("__rank"))).over(own))
    at = lambda c: F.max(F.when(F.col("__rank") == F.col("__open"), F.col(c))).over(own)
    rows = rows.withColumn("__rest", at("__left")).withColumn("__parts", at("__weights")).withColumn("__from", at("__lighter"))
    # shares are cut from the running weight, so that they add up to the rest
    cut = lambda weight: F.expr(f"cast(__rest as {_WIDE}) * cast({weight} as {_WIDE}) div cast(__parts as {_WIDE})")
    share = F.when(F.col("__parts") > 0, cut("__lighter - __from + weight") - cut("__lighter - __from")).otherwise(F.lit(0))
    budget = F.when(F.col("weight") <= 0, F.lit(0)).when(F.col("__open").isNull() | (F.col("__rank") < F.col("__open")), F.col("capacity")).otherwise(share)
    return rows.withColumn("budget", budget.cast("long")).select(*nodes.columns, "budget")


def budgets(leaves: DataFrame, levels: Sequence[Level], share: float, epochs: int) -> DataFrame:
    """The leaves (level columns, `n_docs`, `n_tokens`) with `budget`, and its `epochs` and `rest`."""
    names = [level.name for level in levels]
    # what lies under a node without weight is never taken, so no node above may be given tokens for it
    weighted = reduce(Column.__and__, [F.coalesce(level.weight, F.lit(0)).cast("long") > 0 for level in levels])
    leaves = leaves.withColumn("capacity", F.when(weighted, F.col("n_tokens") * epochs).otherwise(F.lit(0)).cast("long"))
    total = leaves.agg(F.floor(F.coalesce(F.sum("n_tokens"), F.lit(0)) * F.lit(share)).cast("long").alias("n")).first()["n"]
    given = None
    upper: list[str] = []
    for i, level in enumerate(levels):
        path = names[: i + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", F.coalesce(level.weight, F.lit(0)).cast("long"))
        # a family without weight takes nothing, however much it was given
        nodes = nodes.withColumn("given", F.lit(total)) if given is None else nodes.join(given.withColumnRenamed("budget", "given"), upper)
        given = settled(fill(nodes, upper, level.name).select(*path, "budget"))
        upper = path
    out = leaves.drop("capacity").join(given, names)
    whole = F.when(F.col("n_tokens") > 0, F.expr("budget div n_tokens")).otherwise(F.lit(0))
    return out.withColumn("epochs", whole.cast("int")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("n_tokens"))


def plan(rows: DataFrame, levels: Sequence[Level], *, share: float, epochs: int, seed: int) -> DataFrame:
    """For each leaf its `budget`, whole `epochs`, and `bound`: the places of the last epoch up to which it is taken.

    `rows`: doc_id, the level columns, n_tokens; computed before.
    """
    names = [level.name for level in levels]
    leaves = settled(rows.groupBy(*names).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    shares = settled(budgets(leaves, levels, share, epochs))
    part = shares.where("rest > 0").select(*names, "epochs", "rest")
    placed = join_small_side(rows, part, names).withColumn("place", place(seed, F.col("epochs")))
    inside, digits, most = placed.withColumn("before", F.lit(0).cast("long")), 0, RANGE_ROWS + 1
    while most > RANGE_ROWS and digits < PLACE_DIGITS:
        digits += RANGE_DIGITS
        last = _range_of_end(inside, names, digits)
        most = last.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("n")).first()["n"]
        inside = join_small_side(placed.withColumn("range", F.substring("place", 1, digits)), last.drop("rows", "rest"), [*names, "range"])
    each = inside.groupBy(*names, "rest", "before", "place").agg(F.sum("n_tokens").alias("n"))
    by_place = Window.partitionBy(*names).orderBy("place")
    taken = each.where(F.col("n") >= 0).withColumn("upto", F.col("before") + F.sum("n").over(by_place)).where("upto <= rest")
    bounds = taken.groupBy(*names).agg(F.max("place").alias("bound"))
    ends = last.join(bounds, names, "left").select(*names, F.coalesce("bound", "range").alias("bound"))
    return shares.join(ends, names, "left")


def _range_of_end(rows: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    """Of each leaf, the range of the order in which its rest ends: `range`, the tokens `before` it, `rest`, `rows`."""
    sums = rows.groupBy(*names, "rest", "before", F.substring("place", 1, digits).alias("range")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows"))
    by_range = Window.partitionBy(*names).orderBy("range")
    run = sums.withColumn("upto", F.col("before") + F.sum("n").over(by_range)).where("upto > rest")
    first = F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"), "rest", "rows"))
    return settled(run.groupBy(*names).agg(first.alias("e")).select(*names, "e.*"))


def narrow(docs: DataFrame, levels: Sequence[Level]) -> DataFrame:
    values = [F.coalesce(level.value.cast("string"), F.lit("")).alias(level.name) for level in levels]
    return docs.select("doc_id", *values, tokens().alias("n_tokens")).where("n_tokens > 0")


def _copies(rows: DataFrame, planned: DataFrame, names: Sequence[str], seed: int) -> DataFrame:
    joined = join_small_side(rows, planned.select(*names, "budget", "epochs", "bound"), names)
    last = F.coalesce(place(seed, F.col("epochs")) <= F.col("bound"), F.lit(False)).cast("int")
    times = F.col("epochs") + last
    return joined.where(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))


def mix(docs: DataFrame, levels: Sequence[Level], *, share: float, epochs: int, seed: int) -> DataFrame:
    """One row for each chosen copy: doc_id, the levels, `epoch`, `n_tokens`, and the leaf's `budget`."""
    names = [level.name for level in levels]
    rows = settled(narrow(docs, levels))
    out = _copies(rows, plan(rows, levels, share=share, epochs=epochs, seed=seed), names, seed)
    return out.select("doc_id", *names, "epoch", "n_tokens", "budget")


def mix_documents(docs: DataFrame, levels: Sequence[Level], *, share: float, epochs: int, seed: int) -> DataFrame:
    """The chosen copies with the documents' own columns and `epoch`, which takes the place of a column of that name."""
    names = [f"__{level.name}" for level in levels]
    rows = settled(narrow(docs, levels))
    planned = plan(rows, levels, share=share, epochs=epochs, seed=seed)
    planned = planned.select(*[F.col(level.name).alias(n) for level, n in zip(levels, names)], "budget", "epochs", "bound")
    planned = planned.select(*names, *[F.col(c).alias(f"__{c}") for c in ("budget", "epochs", "bound")])
    values = [F.coalesce(level.value.cast("string"), F.lit("")).alias(n) for level, n in zip(levels, names)]
    own = [c for c in docs.columns if c != "epoch"]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own], *values).where(tokens() > 0)
    joined = join_small_side(keyed, planned, names)
    last = F.coalesce(place(seed, F.col("__epochs")) <= F.col("__bound"), F.lit(False)).cast("int")
    times = F.col("__epochs") + last
    return joined.where(times > 0).select(*[F.col(f"`{c}`") for c in own], F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))


def domain_tree() -> list[Level]:
    """The tree of `documents`: sources are numbered, every fourth one is of the same domain."""
    number = F.regexp_extract(F.col("source"), "[0-9]+", 0).try_cast("int")
    domain = F.coalesce(F.concat(F.lit("d"), (number % 4).cast("string")), F.lit(""))
    by = lambda name, weights: F.coalesce(*[F.when(F.col(name) == k, w) for k, w in weights.items()], F.lit(1))
    return [
        Level("domain", domain, by("domain", {"d0": 4, "d1": 3, "d2": 2})),
        Level("language", F.col("lang"), by("language", {"en": 4, "de": 2, "fr": 2})),
        Level("origin", F.col("source"), F.lit(1)),
    ]


_FILL = """
{out}_a as (select *, case when weight > 0 then capacity::double / weight else 'inf'::double end ratio from {nodes}),
{out}_b as (select *, row_number() over w rank, coalesce(sum(capacity) over b, 0)::hugeint taken, coalesce(sum(weight) over b, 0)::hugeint lighter,
  sum(weight) over (partition by {family})::hugeint total
  from {out}_a window w as (partition by {family} order by ratio, {node}), b as (partition by {family} order by ratio, {node} rows between unbounded preceding and 1 preceding)),
{out}_c as (select *, min(case when not (capacity::hugeint * (total - lighter) <= (given - taken) * weight) then rank end) over (partition by {family}) open from {out}_b),
{out}_d as (select *, max(case when rank = open then given - taken end) over (partition by {family}) rest, max(case when rank = open then total - lighter end) over (partition by {family}) parts,
  max(case when rank = open then lighter end) over (partition by {family}) base from {out}_c),
{out} as (select {path}, (case when open is null or rank < open then capacity else (rest * (lighter - base + weight)) // parts - (rest * (lighter - base)) // parts end)::bigint budget from {out}_d)"""

ORACLE = """
with docs as (select doc_id, coalesce('d' || (try_cast(nullif(regexp_extract(source, '[0-9]+'), '') as int) % 4), '') as domain, coalesce(lang, '') as language, coalesce(source, '') as origin,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens from documents where len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) > 0),
leaves as (select domain, language, origin, sum(n_tokens)::bigint n_tokens, {epochs} * sum(n_tokens)::bigint capacity from docs group by all),
total as (select floor(sum(n_tokens) * {share})::bigint given from leaves),
n1 as (select domain, sum(capacity)::bigint capacity, case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end weight, given from leaves, total group by domain, given),
{f1},
n2 as (select domain, language, sum(capacity)::bigint capacity, case language when 'en' then 4 when 'de' then 2 when 'fr' then 2 else 1 end weight, budget given from leaves join f1 using (domain) group by domain, language, budget),
{f2},
n3 as (select domain, language, origin, capacity, 1 weight, budget given from leaves join f2 using (domain, language)),
{f3},
shares as (select *, (budget // n_tokens)::int epochs, budget - (budget // n_tokens) * n_tokens rest from leaves join f3 using (domain, language, origin)),
placed as (select *, md5('{seed}:' || epochs || ':' || coalesce(doc_id::varchar, '')) place from docs d join (select domain, language, origin, epochs, rest, budget from shares) using (domain, language, origin)),
run as (select *, sum(n_tokens) over (partition by domain, language, origin order by place range between unbounded preceding and current row) upto from placed),
copies as (select *, epochs + (upto <= rest and rest > 0)::int times from run)
select doc_id, domain, language, origin, unnest(range(times))::int as epoch, n_tokens, budget from copies where times > 0
"""


def oracle(share: float, epochs: int, seed: int) -> str:
    filled = {
        "f1": _FILL.format(out="f1", nodes="n1", family="0", node="domain", path="domain"),
        "f2": _FILL.format(out="f2", nodes="n2", family="domain", node="language", path="domain, language"),
        "f3": _FILL.format(out="f3", nodes="n3", family="domain, language", node="origin", path="domain, language, origin"),
    }
    return ORACLE.format(share=share, epochs=epochs, seed=seed, **filled)
