"""Mixing sources to target weights by budgets that flow down a tree of domain, language and source.

The leaves' token counts are gathered (one row per leaf, refused beyond ``MAX_LEAVES``); the budget
is split on the driver by weight from the root down. A node that can't use its share leaves a
shortage, which its siblings take up first, then the siblings of its parent, and so on. Each leaf
then gets its token budget as whole epochs plus a prefix of one more, in an order drawn from the
seed, the epoch, the id and the whole row. The prefix is found without sorting a leaf in one task:
rows fall into buckets by their place in that order, the buckets' token sums are accumulated first,
and only inside a bucket rows are sorted. Wholly equal rows are one row with a number from the start,
so copies of a row fill no bucket, and the result is the same under any partitioning.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_often, copied, cut, documents, row_hash, text_or_empty

#: A mix has this many leaves at most; more means that the source column is no source.
MAX_LEAVES = 100_000
#: Rows that one bucket of a leaf holds on average.
BUCKET_ROWS = 500
SEED = 20240607
#: Production weights: domains by a rule on the source, languages and sources by name; others weigh 1.
WEIGHTS = {"domain": {"web": 5.0, "books": 2.0, "code": 1.0, "forums": 2.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}, "source": {"src0": 2.0}}
DOMAINS = ("web", "books", "code", "forums")
#: Share of all tokens that the production mix takes, and how often it may repeat a document.
SHARE, MAX_EPOCHS = 0.6, 2


def tokens(text_col: str) -> Column:
    """White-space separated words, the measure of the budget unless a column is given."""
    return F.size(F.filter(F.split(text_or_empty(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")


def domain_of(source_col: str = "source") -> Column:
    """A domain for each source: by the number in its name, web without one."""
    n = F.try_to_number(F.regexp_extract(F.coalesce(F.col(source_col).cast("string"), F.lit("")), r"(\d{1,9})$", 1), F.lit("999999999"))
    return F.coalesce(F.get(F.array(*map(F.lit, DOMAINS)), (F.coalesce(n, F.lit(0)) % len(DOMAINS)).cast("int")), F.lit(DOMAINS[0]))


def split_budget(total: int, children: dict, weight) -> dict:
    """Shares of ``total`` for children of capacity ``children[name]`` by weight; shortages go to the others.

    The result sums to min(total, sum of capacities). Remainders go one by one, in name order.
    """
    left, share, open_ = min(total, sum(children.values())), dict.fromkeys(children, 0), {k for k, c in children.items() if c > 0}
    while left > 0 and open_:
        whole = sum(weight(k) for k in open_)
        if whole <= 0:  # only children of weight 0 have room: they share alike
            weight, whole = (lambda k: 1.0), float(len(open_))
        given = {k: min(int(left * weight(k) / whole), children[k] - share[k]) for k in open_}
        if not sum(given.values()):
            for k in sorted(open_, key=lambda k: (-weight(k), str(k))):
                if left and children[k] > share[k]:
                    share[k] += 1
                    left -= 1
            open_ = {k for k in open_ if share[k] < children[k]}
            continue
        full = {k for k in open_ if share[k] + given[k] >= children[k]}
        take = given if not full else {k: given[k] for k in full}  # settle the short ones first, then share anew
        for k, n in take.items():
            share[k] += n
            left -= n
        open_ -= full
        if not full:  # only rounding is left
            for k in sorted(open_, key=lambda k: (-weight(k), str(k))):
                if left and share[k] < children[k]:
                    share[k] += 1
                    left -= 1
            open_ = {k for k in open_ if share[k] < children[k]}
    return share


def budgets(leaves: dict[tuple, int], total: int, max_epochs: int, weights: dict[str, dict], levels: tuple[str, ...]) -> dict[tuple, int]:
    """Tokens for each leaf; ``leaves`` maps a path to the tokens there are."""

    def down(paths: dict[tuple, int], depth: int, amount: int) -> dict[tuple, int]:
        if depth == len(levels):
            return dict.fromkeys(paths, amount)
        below: dict = {}
        for p, n in paths.items():
            below.setdefault(p[depth], {})[p] = n
        room = {k: max_epochs * sum(own.values()) for k, own in below.items()}
        shares = split_budget(amount, room, lambda k: float(weights.get(levels[depth], {}).get(k, 1.0)))
        out: dict[tuple, int] = {}
        for k, part in shares.items():
            out.update(down(below[k], depth + 1, part))
        return out

    return down(leaves, 0, total)


def leaf_table(spark: SparkSession, leaves: list[tuple]) -> DataFrame:
    """Rows of domain, lang, source, leaf_budget, _there, _buckets; from Arrow, as a list of tuples would start Python workers that stay beside those of the next stage."""
    kinds = {"domain": pa.string(), "lang": pa.string(), "source": pa.string(), "leaf_budget": pa.int64(), "_there": pa.int64(), "_buckets": pa.int32()}
    return spark.createDataFrame(pa.table([pa.array([x[k] for x in leaves], kind) for k, kind in enumerate(kinds.values())], names=list(kinds)))


def mix(
    df: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, weights: dict[str, dict] | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source", token_col: str | None = None, seed: int = SEED, carry: bool = False,
) -> DataFrame:
    """The chosen rows, once per epoch: id, domain, lang, source, epoch, n_tokens, leaf_budget, tokens_before.

    ``share`` of all tokens is the budget. A document is chosen in an epoch while the tokens before
    it in the leaf's order are fewer than what the budget leaves for that epoch, so the last one may
    run over. Documents of no token come with each whole epoch, and with a prefix that they are in.
    Null lang and source count as the empty string; null and empty texts have no tokens, texts of any
    length count whole. Rows that share an id, null included, are ordered by a hash of the whole row;
    wholly equal rows stand next to each other. Other columns decide no more than that order,
    whatever their names. An empty table gives an empty result. With ``carry``, the columns of ``df``
    are returned instead, each row as often as it was chosen.
    """
    weights = WEIGHTS if weights is None else weights
    clear = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    levels = ("domain", "lang", "source")
    rows = df.select(
        F.col(f"`{id_col}`").alias("_id"), row_hash(df).alias("_row"), domain_of(f"`{source_col}`").alias("domain"), clear(lang_col).alias("lang"), clear(source_col).alias("source"),
        (F.coalesce(F.col(f"`{token_col}`").cast("bigint"), F.lit(0)) if token_col else tokens(text_col)).alias("n_tokens"),
    )
    # The texts are read once; from here on there are only ids and numbers.
    rows = cut(rows.groupBy(*levels, "_id", "_row", "n_tokens").agg(F.count(F.lit(1)).alias("_copies")))
    stats = rows.groupBy(*levels).agg(F.sum(F.col("n_tokens") * F.col("_copies")).alias("n"), F.count(F.lit(1)).alias("rows")).limit(MAX_LEAVES + 1).collect()
    if len(stats) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    leaves = {(r["domain"], r["lang"], r["source"]): int(r["n"]) for r in stats}
    plan = budgets(leaves, int(share * sum(leaves.values())), max_epochs, weights, levels)
    table = [(*k, int(plan[k]), leaves[k], max(1, int(r["rows"]) // BUCKET_ROWS)) for r in stats for k in [(r["domain"], r["lang"], r["source"])]]
    given = F.broadcast(leaf_table(df.sparkSession, table))
    epochs = F.when(F.col("_there") > 0, F.ceil(F.col("leaf_budget") / F.col("_there"))).otherwise(F.lit(0)).cast("int")
    placed = rows.join(given, list(levels)).filter(F.col("leaf_budget") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(epochs - 1, F.lit(0)))))
    placed = placed.withColumn("_order", F.xxhash64(F.lit(seed), "epoch", F.coalesce(F.col("_id").cast("string"), F.lit("")), "_row"))
    placed = placed.withColumn("_budget", F.col("leaf_budget") - F.col("epoch") * F.col("_there"))
    # Bucket numbers follow the order of the hashes.
    placed = placed.withColumn("_bucket", F.least(F.floor((F.col("_order") / 2.0**64 + 0.5) * F.col("_buckets")).cast("int"), F.col("_buckets") - 1))
    leaf, mine = [*levels, "epoch"], F.col("n_tokens") * F.col("_copies")
    sums = placed.groupBy(*leaf, "_bucket").agg(F.sum(mine).alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy(*leaf).orderBy("_bucket")) - F.col("_sum")).drop("_sum")
    placed = placed.join(sums, [*leaf, "_bucket"])
    whole = F.col("_budget") >= F.col("_there")
    inside = placed.filter((F.col("_before") < F.col("_budget")) | whole)
    order = Window.partitionBy(*leaf, "_bucket").orderBy("_order", "_id", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = inside.withColumn("_start", F.col("_before") + F.sum(mine).over(order) - mine)
    # Of equal rows as many are chosen as begin before the budget ends.
    begin = F.when(F.col("_start") >= F.col("_budget"), 0).when(F.col("n_tokens") == 0, F.col("_copies")).otherwise(F.least("_copies", F.ceil((F.col("_budget") - F.col("_start")) / F.greatest("n_tokens", F.lit(1)))))
    at = at.withColumn("_taken", F.when(whole, F.col("_copies")).otherwise(begin).cast("bigint"))
    if carry:
        taken = at.groupBy(F.col("_id").alias("_of"), F.col("_row").alias("_of_row")).agg(F.sum("_taken").alias("_times"))
        others = rows.select("_id", "_row", "_copies").join(taken, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row")), "left")
        return as_often(df, id_col, others.withColumn("times", F.coalesce("_times", F.lit(0))).filter("times <> _copies").select("_id", "_row", "times"))
    return copied(at, "_taken").select(F.col("_id").alias(id_col), *levels, "epoch", "n_tokens", "leaf_budget", (F.col("_start") + (F.col("_copy") - 1) * F.col("n_tokens")).alias("tokens_before"))


def op10_mix(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


QUERIES = {"op10_mix": op10_mix}
SQL: dict[str, str] = {}
