"""Mixing sources to target weights by hierarchical budgeting.

Weights run down a tree: domain, language, source. A node shares its budget among its children by
weight; a child whose whole subtree has less than its share gives all it has, and what is short
goes to its siblings in proportion to their weights. Only what all siblings together cannot give
is missing one level up, where it goes to the siblings there. A leaf gives at most ``max_epochs``
passes over its documents: whole epochs first, then the longest prefix, in a seeded order, that
fits the rest.

Budgets are whole numbers, rounded down at each node, so a mix may stay a few tokens per node
below its budget. The order of an epoch is cut into 65,536 slices of equal hash range: slice sums
tell which slices are in, and only the one slice that the cut falls into is ordered row by row.
So a leaf with a third of all rows is never gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relocate.llm.common import fresh_names, set_aside, whole, words
from relocate.session import settle

TREE = ["domain", "language", "leaf"]
#: Hex digits of the order hash that name a slice.
SLICE_DIGITS = 4
ADDED = ["epoch", "domain", "n_tokens", "leaf_target"]
#: Names the work itself uses; input columns of these names are set aside meanwhile.
_INSIDE = [
    "_key", "_domain", "_language", "_leaf", "_tokens", "_given", "_whole", "_rest", "_slice", "_before", "_order",
    "_in_rest",
]


@dataclass(frozen=True)
class Weights:
    """Target weights, whole numbers of at least one; children not named weigh ``default``.

    ``domains`` maps a domain to its weight; the sources of a domain are those whose number, at
    the end of the name, leaves its place in ``domains`` as remainder. Other names are ``other``.
    """

    domains: dict[str, int] = field(default_factory=lambda: {"web": 5, "books": 3, "forums": 2})
    languages: dict[str, int] = field(default_factory=lambda: {"en": 6, "de": 2, "fr": 1, "es": 1})
    sources: dict[str, int] = field(default_factory=lambda: {"src0": 4})
    default: int = 1

    def domain(self, source: Column) -> Column:
        number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
        names = F.array(*[F.lit(d) for d in self.domains])
        place = F.when(number != "", number.cast("int") % len(self.domains))
        return F.coalesce(F.get(names, place), F.lit("other"))

    def weight(self, table: dict[str, int], name: Column) -> Column:
        found = F.lit(self.default)
        for key, weight in table.items():
            found = F.when(name == key, weight).otherwise(found)
        return found.cast("long")


@dataclass(frozen=True)
class Mix:
    """How much to take, out of a hundred parts of all tokens, and how."""

    weights: Weights = Weights()
    percent: int = 60
    max_epochs: int = 2
    seed: int = 42


def _shared_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Give each node its part (``given``) of its parent's ``budget``; at most ``cap`` each.

    A node is full when all nodes that fill up no later, and the water level it would take to
    fill it in the others, fit into the budget.
    """
    siblings = Window.partitionBy(*parent)
    by_need = siblings.orderBy(F.col("cap") / F.col("weight"))
    nodes = nodes.withColumns(
        {
            "_caps": F.sum("cap").over(by_need),
            "_weights": F.sum("weight").over(by_need),
            "_all": F.sum("weight").over(siblings),
        }
    ).withColumn(
        "_full",
        F.expr("_caps * weight + cap * (_all - _weights) <= budget * weight"),
    )
    full = lambda c: F.sum(F.when(F.col("_full"), F.col(c)).otherwise(0)).over(siblings)
    nodes = nodes.withColumns({"_full_cap": full("cap"), "_full_weight": full("weight")})
    given = F.when(F.col("_full"), F.col("cap")).otherwise(
        F.expr("(budget - _full_cap) * weight div (_all - _full_weight)")
    )
    return nodes.withColumn("given", given).drop(
        "_caps", "_weights", "_all", "_full", "_full_cap", "_full_weight"
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``domain, language, leaf, tokens, given`` from ``domain, language, leaf, tokens``."""
    w = mix.weights
    leaves = leaves.withColumns(
        {"cap": F.col("tokens") * mix.max_epochs, "weight": w.weight(w.sources, F.col("leaf"))}
    )
    languages = (
        leaves.groupBy("domain", "language")
        .agg(F.sum("cap").alias("cap"))
        .withColumn("weight", w.weight(w.languages, F.col("language")))
    )
    domains = (
        languages.groupBy("domain")
        .agg(F.sum("cap").alias("cap"))
        .withColumn("weight", w.weight(w.domains, F.col("domain")))
    )
    total = leaves.agg(F.expr(f"sum(tokens) * {mix.percent} div 100")).scalar()
    root = domains.withColumns({"budget": total, "root": F.lit(0)})
    shared = _shared_out(root, ["root"]).select("domain", F.col("given").alias("budget"))
    shared = _shared_out(languages.join(shared, "domain"), ["domain"])
    shared = shared.select("domain", "language", F.col("given").alias("budget"))
    shared = _shared_out(leaves.join(shared, ["domain", "language"]), ["domain", "language"])
    return shared.select(*TREE, "tokens", "given")


def _order(key: Column, seed: int, epoch: Column) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.md5(text.cast("binary"))


def mix_documents(
    docs: DataFrame,
    mix: Mix = Mix(),
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows of the mix with all input columns and ``epoch``, ``domain``, ``n_tokens``, ``leaf_target``.

    A document comes once per epoch it is taken in. Tokens are words; documents without words are
    never taken. Null languages and sources are leaves of their own. Rows that repeat an id are
    documents of their own and stand beside each other in the order. Input columns with the
    names of added ones are replaced.
    """
    docs = fresh_names(docs, ADDED)
    held = {c: f"_own_{c}" for c in docs.columns if c.lower() in _INSIDE}
    docs = docs.withColumnsRenamed(held)
    key, text, lang, source = (held.get(c, c) for c in (key, text, lang, source))
    place = {
        "_domain": mix.weights.domain(F.col(source)),
        "_language": whole(lang),
        "_leaf": whole(source),
    }
    counted = settle(
        docs.select(
            F.col(key).alias("_key"),
            *[c.alias(n) for n, c in place.items()],
            F.size(words(F.col(text))).cast("long").alias("_tokens"),
        ).filter("_tokens > 0"),
        "tokens",
    )
    leaves = counted.groupBy(*[F.col(f"_{n}").alias(n) for n in TREE]).agg(F.sum("_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, mix).select(
        *[F.col(n).alias(f"_{n}") for n in TREE],
        F.col("given").alias("_given"),
        F.expr("given div tokens").alias("_whole"),
        F.expr("given % tokens").alias("_rest"),
    )
    names = [f"_{n}" for n in TREE]

    order = _order(F.col("_key"), mix.seed, F.col("_whole"))
    slices = (
        counted.join(budgets, names)
        .groupBy(*names, "_rest", F.substring(order, 1, SLICE_DIGITS).alias("_slice"))
        .agg(F.sum("_tokens").alias("_sum"))
    )
    upto = F.sum("_sum").over(Window.partitionBy(*names).orderBy("_slice"))
    cuts = (
        slices.withColumn("_upto", upto)
        .filter("_upto > _rest")
        .groupBy(*names)
        .agg(F.min(F.struct("_slice", (F.col("_upto") - F.col("_sum")).alias("_before"))).alias("_cut"))
    )
    plan = settle(budgets.join(cuts, names).select(*names, "_given", "_whole", "_rest", "_cut.*"), "mix")

    rows = docs.withColumns(place).join(plan, names)
    rows = rows.withColumn("_order", _order(F.col(key), mix.seed, F.col("_whole")))
    mark = F.substring("_order", 1, SLICE_DIGITS)
    rows = rows.withColumn("_tokens", F.size(words(F.col(text))).cast("long"))
    running = F.sum("_tokens").over(
        Window.partitionBy(*names)
        .orderBy("_order", key, "_tokens")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    at_cut = (
        rows.filter((mark == F.col("_slice")) & (F.col("_tokens") > 0))
        .withColumn("_in_rest", F.col("_before") + running <= F.col("_rest"))
    )
    others = rows.filter((mark != F.col("_slice")) & (F.col("_tokens") > 0)).withColumn(
        "_in_rest", mark < F.col("_slice")
    )
    chosen = at_cut.unionByName(others)
    epochs = F.expr("sequence(0, cast(_whole as int) - 1 + cast(_in_rest as int), 1)")
    any_epoch = F.col("_whole") + F.col("_in_rest").cast("long") > 0
    return chosen.filter(any_epoch).select(
        *docs.columns,
        F.explode(epochs).alias("epoch"),
        F.col("_domain").alias("domain"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_given").alias("leaf_target"),
    ).withColumnsRenamed({name: c for c, name in held.items()})


def take_mix(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """The rows of the mix with the input's columns, whatever their names."""
    docs, own = set_aside(docs, ADDED)
    return own(mix_documents(docs, mix, **columns))
