"""Mix sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import split_join
from ..operators.ranking import assign_uid, top_k
from .common import prepare, whole_row, written
from .graph import components

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Documents of a pattern are dealt to this many seeded slices, and each of those once more.
SLICES = 1 << 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(source, size, weight, target) from (source, size), one row per source.

    Sources in code point order, null last, get the weights in turn. They share the
    sum of all sizes by weight; a target stops at `most_repeats` times its source and
    the excess is shared again by weight, until no target is above its stop.
    """
    named = assign_uid(sizes.select("source", "size"), [F.col("source").asc_nulls_last()], "_place")
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    table = written(
        named.select(
            "source",
            "size",
            F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
            (F.lit(float(most_repeats)) * F.col("size")).alias("stop"),
        ),
        "source_table",
    )
    level, before = 0.0, None
    # Every round stops at least one more source, or is the last; each is one small aggregate.
    while level != before:
        before = level
        stopped = F.col("stop") <= F.lit(level) * F.col("weight")
        sums = table.agg(
            F.sum("size").alias("all"),
            F.sum(F.when(stopped, F.col("stop"))).alias("stopped"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("open"),
        ).first()
        if sums["open"]:
            level = max(level, ((sums["all"] or 0) - (sums["stopped"] or 0.0)) / sums["open"])
    return table.select(
        "source", "size", "weight", F.least(F.col("stop"), F.lit(level) * F.col("weight")).alias("target")
    )


def route(
    capacity: Mapping[tuple, int], quota: Mapping[object, float], most_repeats: int = MOST_REPEATS
) -> dict[tuple, dict[object, float]]:
    """Words that each membership pattern gives to each of its sources.

    A min-cost flow: pattern p holds capacity[p] words and may give them `most_repeats`
    times, each further time at a higher cost; a source takes its quota at most. Flow is
    pushed along cheapest augmenting paths until none is left, so that the quotas are met
    as far as they can be, with as few repeats as they can be.

    The network has one node per pattern and per source, however many documents there are.
    """
    flow = {p: dict.fromkeys(p, 0.0) for p in capacity}
    given = dict.fromkeys(capacity, 0.0)
    taken = dict.fromkeys(quota, 0.0)
    small = 1e-9 * max(1.0, sum(quota.values()))
    members = {s: [p for p in capacity if s in p] for s in quota}

    def distances():
        """Cheapest way from the start to every pattern; costs are how often it has been given."""
        dist, via = {}, {}
        for p, words in capacity.items():
            used = given[p] / words if words else most_repeats
            if used < most_repeats - 1e-12:
                dist[p], via[p] = int(used + 1e-12) + 1, None
        # Reaching another pattern through a shared source undoes its flow there, at no cost.
        todo = sorted(dist, key=dist.get)
        reached = {}
        while todo:
            p = todo.pop(0)
            for s in p:
                if s in reached:
                    continue
                reached[s] = p
                for q in members[s]:
                    if q not in dist and flow[q][s] > small:
                        dist[q], via[q] = dist[p], (p, s)
                        todo.insert(0, q)
        return dist, via, reached

    while True:
        dist, via, reached = distances()
        ends = [s for s in reached if quota[s] - taken[s] > small]
        if not ends:
            return flow
        end = min(ends, key=lambda s: dist[reached[s]])
        steps, p = [(reached[end], end, None)], reached[end]
        while via[p] is not None:
            back, s = via[p]
            steps.append((back, s, p))
            p = back
        epoch = int(given[p] / capacity[p] + 1e-12) + 1
        push = min(
            [quota[end] - taken[end], epoch * capacity[p] - given[p]]
            + [flow[q][s] for _, s, q in steps if q is not None]
        )
        for giver, s, undone in steps:
            flow[giver][s] += push
            if undone is not None:
                flow[undone][s] -= push
        given[p] += push
        taken[end] += push


def _key_of(source: Column) -> Column:
    """Null is no key of a join; its JSON is, and is kept apart from texts."""
    return F.to_json(F.struct(source.alias("s")), {"ignoreNullFields": "false"})


def _pattern_words(sized: DataFrame, targets: DataFrame, most_repeats: int) -> DataFrame:
    """(sources, words): how many words each membership pattern is to give.

    Sources that no chain of patterns connects don't share any flow, so each connected part is a network of
    its own, with one row per pattern that occurs in it, and is routed by a task.
    """
    patterns = written(sized.groupBy("sources").agg(F.sum("size").alias("capacity")).filter(F.size("sources") > 0), "patterns")
    first = _key_of(F.get("sources", F.lit(0)))
    others = F.explode(F.transform(F.slice("sources", 2, F.size("sources")), _key_of))
    connected = components(patterns.select(first.alias("a"), others.alias("b")))
    part = F.coalesce("component", "node").alias("part")
    of_pattern = split_join(patterns.withColumn("node", first), connected, "node", "left").select(part, "sources", "capacity")
    quotas = split_join(targets.withColumn("node", _key_of(F.col("source"))), connected, "node", "left")

    def flow(network: pa.Table, wanted: pa.Table) -> pa.Table:
        capacity = {tuple(p): c for p, c in zip(network["sources"].to_pylist(), network["capacity"].to_pylist(), strict=True)}
        quota = dict(zip(wanted["source"].to_pylist(), wanted["target"].to_pylist(), strict=True))
        given = route(capacity, quota, most_repeats)
        return pa.table(
            {
                "sources": pa.array([list(p) for p in given], pa.list_(pa.string())),
                "words": pa.array([float(sum(to.values())) for to in given.values()], pa.float64()),
            }
        )

    sides = of_pattern.groupBy("part"), quotas.select(part, "source", "target").groupBy("part")
    return written(sides[0].cogroup(sides[1]).applyInArrow(flow, "sources array<string>, words double"), "flow")


def mix_documents(
    docs: DataFrame,
    sources: Column | str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: int = 17,
) -> DataFrame:
    """One row per document: (id, sources, size, source_size, target, times).

    `sources` is a text column, or an array column for documents that lie in several
    sources. `times` says how often the mix takes the document whole: every document of
    a pattern as often as its words fit into what the pattern gives, and a seeded choice
    of them once more. `source_size` and `target` are those of the document's first source.

    Null is a source of its own. A document without words adds nothing to any sum and is
    taken like those around it in the seeded order, once where its pattern has no words at
    all; one without a source is never taken. Rows alike in id, text and sources are chosen
    together. An empty table gives an empty mix.
    """
    prepare(docs.sparkSession)
    place = F.col(sources) if isinstance(sources, str) else sources
    if not docs.select(place.alias("p")).schema["p"].dataType.typeName() == "array":
        place = F.array(place)
    draw = _draw(id_col, text_col, place, seed)
    sized = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.array_sort(F.array_distinct(place)).alias("sources"),
            word_count(F.col(text_col)).alias("size"),
            draw.alias("draw"),
        ),
        "sized",
    )
    sizes = sized.select(F.explode("sources").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("size"))
    targets = source_targets(sizes, weights, most_repeats)

    # Null is no key of a join; the JSON of a pattern is, and keeps null apart from texts.
    key = F.to_json(F.struct("sources"), {"ignoreNullFields": "false"}).alias("key")
    slice_ = F.shiftrightunsigned("draw", 54)
    finer = F.shiftrightunsigned("draw", 44).bitwiseAND(SLICES - 1)
    rows = sized.select("*", key, slice_.alias("slice"), finer.alias("finer"))
    words = _pattern_words(sized, targets, most_repeats).select(key, "words")
    totals = rows.groupBy("key").agg(F.sum("size").alias("total"))
    goal = words.join(totals, "key").select(
        "key",
        F.when(F.col("total") > 0, F.floor(F.col("words") / F.col("total") + F.lit(1e-12))).otherwise(F.lit(0)).alias("rounds"),
        "words",
        "total",
    )
    goal = written(goal.select("key", "rounds", (F.col("words") - F.col("rounds") * F.col("total")).alias("rest")), "goal")

    first = _last_whole(rows, goal.select("key", "rest"), ["key"], "slice")
    second = _last_whole(
        split_join(rows, first.select("key", F.col("edge").alias("slice"), "rest"), ["key", "slice"]).drop("rest"),
        first.select("key", "rest"),
        ["key"],
        "finer",
    )
    edges = first.select("key", "edge").join(
        second.select("key", F.col("edge").alias("finer_edge"), F.col("rest").alias("left")), "key", "left"
    )
    # No document begins at the edge where the slices end with nothing left to take.
    edges = written(edges.withColumn("finer_edge", F.coalesce("finer_edge", F.lit(SLICES))), "edges")
    before = (F.col("slice") < F.col("edge")) | (
        (F.col("slice") == F.col("edge")) & (F.col("finer") < F.col("finer_edge"))
    )
    chosen = _fill(rows, edges, before)

    marked = split_join(rows, edges.select("key", "edge", "finer_edge"), "key", "left").withColumn(
        "below", F.coalesce(before, F.lit(False))
    )
    marked = split_join(marked, chosen, ["key", "draw"], "left")
    marked = split_join(marked, goal.select("key", "rounds"), "key", "left")
    times = F.coalesce("rounds", F.lit(0)) + F.when(F.col("below") | F.coalesce("chosen", F.lit(False)), 1).otherwise(0)
    at = targets.select(
        F.to_json(F.struct(F.col("source").alias("s")), {"ignoreNullFields": "false"}).alias("at"),
        F.col("size").alias("source_size"),
        "target",
    )
    first_source = F.struct(F.get("sources", F.lit(0)).alias("s"))
    home = F.when(F.size("sources") > 0, F.to_json(first_source, {"ignoreNullFields": "false"}))
    return split_join(marked.withColumn("at", home), at, "at", "left").select(
        F.col("id").alias(id_col),
        "sources",
        "size",
        "source_size",
        "target",
        F.least(times, F.lit(most_repeats)).cast("int").alias("times"),
        "draw",
    )


def _draw(id_col: str, text_col: str, place: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col), place)


def repeat_documents(
    docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 17, **mix
) -> DataFrame:
    """The documents, whole rows, each as often as `mix_documents` takes it; sources are one text column."""
    mixed = mix_documents(docs, source_col, id_col, text_col, seed=seed, **mix)
    times = mixed.groupBy("draw").agg(F.max("times").alias("times")).filter("times > 0")
    drawn = docs.select(whole_row(docs).alias("row"), _draw(id_col, text_col, F.array(source_col), seed).alias("draw"))
    copies = F.explode(F.sequence(F.lit(1), F.col("times")))
    return split_join(drawn, times, "draw").select("row", copies).select("row.*")


def _last_whole(rows: DataFrame, goal: DataFrame, keys: list[str], slice_: str) -> DataFrame:
    """(key, edge, rest): slices before `edge` fit whole into the rest, which shrinks by them."""
    sums = rows.groupBy(*keys, slice_).agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy(*keys).orderBy(slice_))  # at most SLICES rows a key
    fits = goal.join(sums, keys).withColumn("so_far", running).withColumn("fits", F.col("so_far") <= F.col("rest"))
    return fits.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(~F.col("fits"), F.col(slice_))), F.lit(SLICES)).alias("edge"),
        (F.first("rest") - F.coalesce(F.max(F.when(F.col("fits"), F.col("so_far"))), F.lit(0))).alias("rest"),
    )


def _fill(rows: DataFrame, edges: DataFrame, before: Column) -> DataFrame:
    """(key, draw, chosen): of all documents after the edge, those that fill what is left.

    They are taken by size, the largest that fits first, until nothing fits; then the smallest
    that is left, if that comes nearer. Of those of one size the seeded order decides. A pattern
    ends within half of the smallest document that it leaves out. What is left at the edge is less
    than a finer slice, so what is taken of one size is few documents, or about as many words as
    a single document holds.
    """
    open_ = edges.filter("left > 0").select("key", "edge", "finer_edge", "left")
    # Larger ones can neither fit nor come nearer.
    near = F.col("size") < 2 * F.col("left")
    after = split_join(rows, open_, "key").filter(~before & near & (F.col("size") > 0))
    # Rows alike are one unit.
    units = after.groupBy("key", "draw").agg(F.sum("size").alias("size"), F.first("left").alias("left")).filter(near)
    units = written(units, "open_units")
    sizes = units.groupBy("key", "size").agg(F.count(F.lit(1)).alias("units"), F.first("left").alias("left"))
    taken = written(sizes.groupBy("key").applyInPandas(_take, "key string, size long, taken long"), "taken")
    most = taken.agg(F.max("taken")).first()[0] or 0
    picked = top_k(split_join(units, taken, ["key", "size"]), ["key", "size"], ["draw"], most, "_turn")
    return picked.filter("_turn <= taken").select("key", "draw", F.lit(True).alias("chosen"))


def _take(sizes):
    """How many units of each size are taken, from one row per size."""
    sizes = sizes.sort_values("size", ascending=False)
    left, taken = float(sizes["left"].iloc[0]), []
    for size, units in zip(sizes["size"], sizes["units"], strict=True):
        taken.append(min(int(units), int(left // size)))
        left -= taken[-1] * size
    # The smallest size of which a unit is left.
    for i in reversed(range(len(taken))):
        if taken[i] < sizes["units"].iloc[i]:
            taken[i] += sizes["size"].iloc[i] < 2 * left
            break
    sizes = sizes.assign(taken=taken)
    return sizes[sizes["taken"] > 0][["key", "size", "taken"]]
