"""Passes that grow the games graph: each takes (nodes, edges) and gives the next ones.

A pass handles all games in one plan. Write the result with `write_graph` and read
it back before the next pass, so that no plan spans several passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import (
    as_key,
    company_prompt,
    default_if_falsy,
    epoch_timestamp,
    first_chars,
    fixed,
    has_number,
    has_text,
    html_to_text,
    iso_stamp,
    site_prompt,
    text_or,
)
from ..operators.aggregates import avg_over_edges, merged_sums, negative, sums_over_edges
from ..operators.enrich import enrich
from ..operators.entities import cooccurrence, entity_nodes
from ..operators.graph import (
    EDGE,
    add_edges,
    as_edges,
    as_nodes,
    assign_props,
    create_nodes,
    detached,
    drop_orphans,
    merge_props,
    new_edges,
    no_props,
    props_map,
    replace_edges,
)
from ..operators.joins import split_join
from ..operators.links import (
    DOCUMENT_FIELDS,
    DOCUMENT_RULES,
    attach_by_name,
    fold_packed,
    known_links,
    link_edges,
    link_targets,
    pack_links,
    similar_edges,
    similar_to,
)
from ..operators.ranking import dedupe_first, top_k, top_n
from ..session import keep, stored
from ..sources.judge import judge_documents, split_judged
from ..sources.tables import lookup_by_ids, search_first

Graph = tuple[DataFrame, DataFrame]

# What documents link to, by which relationship.
TARGETS = {
    fixed.RELEASE_YEAR: fixed.RELEASED_IN,
    fixed.FRANCHISE: fixed.PART_OF_FRANCHISE,
    fixed.GAME_TYPE: fixed.HAS_TYPE,
    fixed.GENRE: fixed.HAS_GENRE,
    fixed.COMPANY: fixed.INVOLVES_COMPANY,
}

BASE_PROPS = ["total_rating", "first_release_date", "summary", "url", "payload"]


def _label(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.filter(F.col("label") == label)


def game_columns(nodes: DataFrame) -> DataFrame:
    """Game nodes as key and name columns."""
    return _label(nodes, fixed.GAME).select("key", F.try_element_at("props", F.lit("name")).alias("name"))


def split_documents(landed: DataFrame, id_field: str = "id", id_type: str = "long") -> tuple[DataFrame, DataFrame]:
    """Landed rows with a usable `payload`, and the others with the reason."""
    good, rejects = split_judged(judge_documents(landed, f"{id_field} {id_type}", id_field))
    return good.drop("doc"), rejects


def newest_documents(landed: DataFrame, nodes: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """First landed document in `order_by` of every catalogue id in the graph: (key, payload, doc).

    Ranking comes before the lookup: what is shuffled is at most one document per id and task. The lookup is an
    inner join on unique keys, since a semi join would be moved below the ranking.
    """
    newest = dedupe_first(landed, ["key"], order_by).select("key", "payload", "doc")
    return newest.join(_label(nodes, fixed.CATALOG_ID).select("key"), "key")


def base_properties(docs: DataFrame) -> DataFrame:
    """The five properties of a catalogue id; no date counts as epoch 0. `docs` has (key, payload, doc)."""
    date = F.col("first_release_date")
    fields = docs.select("key", "payload", *[f"doc.{c}" for c in ("total_rating", "first_release_date", "summary", "url")])
    return fields.withColumn(
        "first_release_date", iso_stamp(epoch_timestamp(default_if_falsy(has_number(date), date, 0)))
    )


class Ingested(NamedTuple):
    """A pass over documents: the graph after it, and the landed rows that were not used, with the reason."""

    nodes: DataFrame
    edges: DataFrame
    rejects: DataFrame


def ingest_documents(
    graph: Graph,
    landed: DataFrame,
    order_by: Sequence[Column | str],
    seq: str,
    observation: Observation | None = None,
) -> Ingested:
    """Properties, target nodes and edges of all landed documents, and the rejects among them.

    `landed` has a JSON column `payload` and `seq`, which grows with every landing.
    The first document per id in `order_by` sets the properties; every document adds
    its links, if its id is a node; a year is made for every document that has one. Documents are
    parsed and judged once and kept as a table in the shared folder, from which each result reads its
    own columns; every landed row is in it, either used or with a reason. The links of a document are shuffled
    as one packed text, by its id, and stay in that task until they are edges. A document of which any
    declared field has another type is not used at all. An `observation` counts rejects by reason.
    """
    nodes, edges = graph
    judged = judge_documents(landed, DOCUMENT_FIELDS, observation=observation)
    key = as_key(F.col("doc.id"))
    packed = [pack_links(DOCUMENT_RULES).alias("_links"), pack_links([similar_to]).alias("_similar")]
    read = judged.select("*", "doc.*").select(*landed.columns, "reason", "doc", key.alias("_key"), *packed)
    held = F.struct(*[F.col(f"doc.{c}") for c in ("total_rating", "first_release_date", "summary", "url")])
    table = stored(read.withColumn("doc", held), "documents")
    used = table.filter("reason IS NULL")
    source = [F.col("_key").alias("src_key"), F.col(seq).alias("seq")]
    linked = used.select(*source, "_links")
    whole = used.select(*source, F.concat_ws("\n", "_links", "_similar").alias("_links")).filter("_links <> ''")
    links = fold_packed(known_links(whole, nodes), ["src_key"])
    own = links.filter(F.col("rel_type") != fixed.SIMILAR_TO)
    newest = newest_documents(used.withColumnRenamed("_key", "key"), nodes, order_by)
    updates = assign_props(base_properties(newest), fixed.CATALOG_ID, "key", BASE_PROPS)
    # A name is only set where the link has one.
    named = F.when(F.col("name").isNotNull(), F.array(F.lit("name"))).otherwise(F.array().cast("array<string>"))
    known = _label(nodes, fixed.CATALOG_ID).select(F.col("key").alias("src_key"), F.lit(True).alias("_known"))
    wanted = lambda rel: (F.col("_known") & (rel != fixed.SIMILAR_TO)) | (rel == fixed.RELEASED_IN)
    found = fold_packed(linked.filter("src_key IS NOT NULL").join(known, "src_key", "left"), wanted=wanted)
    targets = link_targets(found).select("label", "key", props_map(["name"]), named.alias("sets"))
    # Added apart, since their types differ: the links of an id stay in the task that folded them.
    similar = new_edges(edges, similar_edges(links, nodes), [fixed.SIMILAR_TO])
    return Ingested(
        merge_props(nodes, updates.unionByName(targets), [fixed.CATALOG_ID, *TARGETS]),
        add_edges(edges, link_edges(own, nodes), [*TARGETS.values()]).unionByName(similar),
        table.filter("reason IS NOT NULL").select(*landed.columns, "reason"),
    )


def stream_graph(
    games: DataFrame, streams: DataFrame, k: int, order_by: Sequence[Column | str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stream nodes, HAS_STREAM edges and games to create, for k streams per game name.

    games(key, name); streams(name, stream_id, title, viewer_count, user_name). The
    streams are ranked once; the few that are left feed all three results.
    """
    best = keep(top_k(streams, ["name"], order_by, k))
    once = dedupe_first(best, ["stream_id"], order_by)  # a stream may be listed under two names
    nodes = assign_props(once, fixed.STREAM, "stream_id", ["title", "viewer_count", "user_name"])
    edges, created = attach_by_name(games, best, "name", "stream_id", fixed.HAS_STREAM, fixed.STREAM)
    return nodes, edges, created


def catalogue_edges(games: DataFrame) -> DataFrame:
    """From every game(key, ...) to the catalogue id of the same key."""
    return as_edges(games, fixed.GAME, "key", fixed.HAS_CATALOG_ID, fixed.CATALOG_ID, "key")


def _add_games(graph: Graph, games: DataFrame, streams: DataFrame, k: int, order) -> Graph:
    """Games(key, name, box_art_url), their catalogue ids and their names' first k streams.

    Five results are made of the games: they are kept, so that what tells them is not read again for each.
    """
    nodes, edges = graph
    games = keep(games)
    own = assign_props(games, fixed.GAME, "key", ["name", "box_art_url"])
    ids = assign_props(games, fixed.CATALOG_ID, "key")
    # Streams are looked up for the games of this pass only, and attached to all of the name.
    wanted = lookup_by_ids(streams, games, "name")
    owners = game_columns(merge_props(nodes, own, [fixed.GAME]))
    best, stream_edges, _ = stream_graph(owners, wanted, k, order)
    incoming = own.unionByName(ids).unionByName(best)
    added = catalogue_edges(games).unionByName(stream_edges)
    return (
        merge_props(nodes, incoming, [fixed.GAME, fixed.CATALOG_ID, fixed.STREAM]),
        add_edges(edges, added, [fixed.HAS_CATALOG_ID, fixed.HAS_STREAM]),
    )


def ingest_top_games(
    graph: Graph,
    games: DataFrame,
    streams: DataFrame,
    game_order: Sequence[Column | str],
    stream_order: Sequence[Column | str],
) -> Graph:
    """The top games, their catalogue ids and their first streams."""
    top = top_n(games, game_order, fixed.TOP_GAMES)
    return _add_games(graph, top, streams, fixed.STREAMS_PER_TOP_GAME, stream_order)


def ingest_top_games_by_name(
    graph: Graph,
    games: DataFrame,
    streams: DataFrame,
    game_order: Sequence[Column | str],
    stream_order: Sequence[Column | str],
) -> Graph:
    """The older form, for a graph whose games are keyed by name: games of one name are one node.

    The node takes its art and catalogue id from the first of them in `game_order` and is linked to the ids of
    all; streams are attached to the name, whose node is made if it is not there.
    """
    nodes, edges = graph
    top = keep(top_n(games, game_order, fixed.TOP_GAMES))  # ten rows
    first = dedupe_first(top.filter(has_text(F.col("name"))), ["name"], game_order)
    own = assign_props(first.withColumn("catalog_id", F.col("key")), fixed.GAME, "name", ["name", "box_art_url", "catalog_id"])
    ids = assign_props(top, fixed.CATALOG_ID, "key")
    best = keep(top_k(lookup_by_ids(streams, top, "name"), ["name"], stream_order, fixed.STREAMS_PER_TOP_GAME))
    once = dedupe_first(best, ["stream_id"], stream_order)
    shown = assign_props(once, fixed.STREAM, "stream_id", ["title", "viewer_count", "user_name"])
    added = as_edges(top, fixed.GAME, "name", fixed.HAS_CATALOG_ID, fixed.CATALOG_ID, "key").unionByName(
        as_edges(best, fixed.GAME, "name", fixed.HAS_STREAM, fixed.STREAM, "stream_id")
    )
    incoming = own.unionByName(ids).unionByName(shown)
    return (
        merge_props(nodes, incoming, [fixed.GAME, fixed.CATALOG_ID, fixed.STREAM]),
        add_edges(edges, added, [fixed.HAS_CATALOG_ID, fixed.HAS_STREAM]),
    )


def ingest_entities(graph: Graph, tokens: DataFrame) -> Graph:
    """Nodes of tagged names, and SELLS edges between companies and products of one document.

    tokens(doc, word, entity). Nodes are merged by label and name; those that are there keep
    their other properties. Edges are only added once.
    """
    nodes, edges = graph
    named = entity_nodes(tokens)
    labels = F.col("label")
    incoming = named.select(labels, F.col("name").alias("key"), F.create_map(F.lit("name"), F.col("name")).alias("props"), F.array(F.lit("name")).alias("sets"))
    kept = nodes.join(incoming.select("label", "key", F.col("props").alias("_new")), ["label", "key"], "full_outer")
    props = F.when(F.col("_new").isNull(), F.col("props")).otherwise(
        F.map_concat(F.map_filter(F.coalesce("props", no_props()), lambda k, _: k != "name"), "_new")
    )
    return kept.select("label", "key", props.alias("props")), add_edges(edges, cooccurrence(tokens), [fixed.SELLS])


def similar_games(docs: DataFrame, catalogue: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Games named as similar that the catalogue knows: (key, name, box_art_url).

    docs has the similar-game schema; catalogue(name, ...) is searched by exact name.
    """
    named = docs.select(F.explode("similar_games").alias("_s")).select(
        as_key(F.col("_s.id")).alias("key"), F.col("_s.name").alias("name"), text_or(F.col("_s.cover.url")).alias("box_art_url")
    )
    # Documents repeat their similar games: drop equal rows before ranking them.
    # A game with a cover in any document keeps it.
    games = dedupe_first(
        named.distinct().filter(has_text(F.col("name"))), ["key"], [F.col("box_art_url").desc(), "name"]
    )
    found = search_first(games, catalogue.select("name").withColumnRenamed("name", "_hit"), "name", "_hit", ["_hit"])
    return lookup_by_ids(games, found, "name").select("key", "name", "box_art_url")


def ingest_similar_games(
    graph: Graph, docs: DataFrame, catalogue: DataFrame, streams: DataFrame, stream_order: Sequence[Column | str]
) -> Graph:
    """Similar games of all documents, their catalogue ids and their first streams."""
    games = similar_games(docs, catalogue, ["name"])
    return _add_games(graph, games, streams, fixed.STREAMS_PER_SIMILAR_GAME, stream_order)


def average_views(games: DataFrame, edges: DataFrame, streams: DataFrame) -> DataFrame:
    """(name, average) over the streams of all games of a name.

    games(key, name), streams(key, viewer_count); edges of the graph.
    """
    hops = edges.filter(F.col("rel_type") == fixed.HAS_STREAM).select("src_key", "dst_key")
    return avg_over_edges(
        hops,
        games.select(F.col("key").alias("src_key"), "name"),
        streams.select(F.col("key").alias("dst_key"), "viewer_count"),
        "src_key",
        "dst_key",
        "name",
        "viewer_count",
    )


def grow_average_views(
    state: DataFrame | None, games: DataFrame, edges: DataFrame, streams: DataFrame, changed: DataFrame | None = None
) -> DataFrame:
    """(name, total, values): the state of the averages after `edges`, which are new, have come in.

    Write the result as a snapshot: it is the next run's `state`, and `averages_of` gives the averages. Only
    the new edges and their streams are read, not those that the state has seen. `changed` (key,
    viewer_count) are the values that streams had before they were set anew; pass their edges among `edges`, and the state
    loses the old values. A game that changes its name keeps its share of the old one.
    """
    hops = edges.filter(F.col("rel_type") == fixed.HAS_STREAM).select("src_key", "dst_key")
    named = games.select(F.col("key").alias("src_key"), "name")
    of = lambda values: sums_over_edges(
        hops, named, values.select(F.col("key").alias("dst_key"), "viewer_count"), "src_key", "dst_key", "name", "viewer_count"
    )
    parts = [of(streams)] + ([state] if state is not None else []) + ([negative(of(changed))] if changed is not None else [])
    return merged_sums(parts, "name")


def average_view_graph(games: DataFrame, averages: DataFrame, key: Column) -> Graph:
    """Value nodes shared by equal averages, and edges from every game of the name."""
    valued = averages.withColumn("_value", key)
    nodes = assign_props(
        valued.select(F.col("_value").alias("value")).distinct(), fixed.AVERAGE_VIEWS, "value", ["value"]
    )
    owners = split_join(games.select("key", "name"), valued, "name")
    return nodes, as_edges(
        owners, fixed.GAME, "key", fixed.HAS_AVERAGE_VIEW_COUNT, fixed.AVERAGE_VIEWS, "_value"
    )


def ingest_average_views(graph: Graph, replace: bool = False) -> Graph:
    """Add average-view edges; those of an earlier run stay unless `replace` is set."""
    nodes, edges = graph
    games = game_columns(nodes)
    streams = _label(nodes, fixed.STREAM).select(
        "key", F.try_element_at("props", F.lit("viewer_count")).cast("double").alias("viewer_count")
    )
    averages = keep(average_views(games, edges, streams))  # one row per name, read for values, links and what they replace
    values, links = average_view_graph(games, averages, as_key(F.col("average")))
    rel = fixed.HAS_AVERAGE_VIEW_COUNT
    nodes = merge_props(nodes, values, [fixed.AVERAGE_VIEWS])
    if not replace:
        return nodes, add_edges(edges, links, [rel])
    after = replace_edges(edges, links, rel)
    return drop_orphans(nodes, after, detached(edges, links, rel), rel, fixed.AVERAGE_VIEWS), after


def company_documents_graph(docs: DataFrame, countries: bool = False) -> Graph:
    """Website (and country) nodes and candidate edges of company documents.

    docs(id, description, url, country). A website is made whether or not the
    company is known; country 0 and an empty url link nothing.
    """
    sited = docs.filter(has_text(F.col("url")))
    nodes = assign_props(sited.select("url").distinct(), fixed.WEBSITE, "url", ["url"])
    edges = as_edges(sited, fixed.COMPANY, "id", fixed.HAS_WEBSITE, fixed.WEBSITE, "url")
    if countries:
        placed = docs.filter(has_number(F.col("country")))
        nodes = nodes.unionByName(
            assign_props(placed.select("country").distinct(), fixed.COUNTRY, "country")
        )
        edges = edges.unionByName(
            as_edges(placed, fixed.COMPANY, "id", fixed.LOCATED_IN, fixed.COUNTRY, "country")
        )
    return nodes, edges


def ingest_companies(
    graph: Graph, docs: DataFrame, order_by: Sequence[Column | str], countries: bool = False
) -> Graph:
    """Descriptions of known companies, and their websites."""
    nodes, edges = graph
    companies = _label(nodes, fixed.COMPANY).select("key")
    described = dedupe_first(docs.withColumn("key", as_key(F.col("id"))), ["key"], order_by)
    updates = assign_props(
        described.join(companies, "key", "left_semi"), fixed.COMPANY, "key", ["description"]
    )
    new_nodes, candidates = company_documents_graph(docs, countries)
    nodes = merge_props(nodes, updates.unionByName(new_nodes), [fixed.COMPANY, fixed.WEBSITE, fixed.COUNTRY])
    # The targets are made here, so only the sources are looked up, and in the stored nodes.
    known = companies.select(F.lit(fixed.COMPANY).alias("src_label"), F.col("key").alias("src_key"))
    started = split_join(candidates, known, ["src_label", "src_key"], "left_semi")
    return nodes, add_edges(edges, started, [fixed.HAS_WEBSITE, fixed.LOCATED_IN])


def ingest_searched_companies(
    graph: Graph,
    docs: DataFrame,
    order_by: Sequence[Column | str],
    countries: bool = False,
    mode: str = "phrase",
) -> Graph:
    """The company pass with its search: every company's name is looked for in the documents' names.

    docs(id, name, description, url, country). The first document in `order_by` that holds the name is
    taken in as by `ingest_companies`: it describes the company of *its* id, where that is known. A
    company whose name no document holds is passed over.
    """
    nodes, _ = graph
    names = _label(nodes, fixed.COMPANY).select(F.try_element_at("props", F.lit("name")).alias("_asked"))
    titled = docs.withColumn("_title", F.col("name"))
    found = search_first(names, titled, "_asked", "_title", order_by, mode=mode).drop("_asked")
    return ingest_companies(graph, found.distinct(), order_by, countries)


def site_summaries(
    pages: DataFrame,
    model: str,
    stamp: str,
    fn: Callable[[str], str] | None = None,
    key: str = "page_id",
    chars: int | None = fixed.SITE_TEXT_CHARS,
) -> DataFrame:
    """One summary per page: (key, url, text, model, timestamp); failed pages are skipped.

    The prompt has the page's first `chars` characters, or all of them if that is None.

    The run's time stamp is passed in. The texts are kept as told: whatever reads
    them sees the same text, and the function is called once per page.
    """
    text = html_to_text(F.col("html"))
    prompt = site_prompt(text if chars is None else first_chars(text, chars))
    asked = pages.filter(has_text(F.col("url"))).select(key, "url", prompt.alias("prompt"))
    told = enrich(asked, "prompt", "text", fn, on_error="skip")
    return keep(told.select(key, "url", "text", F.lit(model).alias("model"), F.lit(stamp).alias("timestamp")))


def ingest_site_summaries(graph: Graph, summaries: DataFrame, key: str = "page_id") -> Graph:
    """Append every summary as a node of its own; a run never replaces earlier ones."""
    nodes, edges = graph
    owned = summaries.withColumn("_key", F.concat_ws("@", as_key(F.col(key)), "timestamp"))
    sites = assign_props(owned.select("url").distinct(), fixed.WEBSITE, "url", ["url"])
    nodes = create_nodes(
        merge_props(nodes, sites, [fixed.WEBSITE]), as_nodes(owned, fixed.SUMMARY, "_key", ["text", "model", "timestamp"])
    )
    links = as_edges(owned, fixed.WEBSITE, "url", fixed.HAS_SUMMARY, fixed.SUMMARY, "_key")
    return nodes, edges.select(*EDGE).unionByName(links)


def company_summaries(nodes: DataFrame, fn: Callable[[str], str] | None = None) -> DataFrame:
    """(name, summary) per distinct company name, kept as told; a failure is stored as the summary."""
    names = (
        _label(nodes, fixed.COMPANY)
        .select(F.try_element_at("props", F.lit("name")).alias("name"))
        .filter(F.col("name").isNotNull())
        .distinct()
        .withColumn("prompt", company_prompt(F.col("name")))
    )
    return keep(enrich(names, "prompt", "summary", fn, on_error="value").select("name", "summary"))


def ingest_company_summaries(graph: Graph, summaries: DataFrame) -> Graph:
    """Give every company of a name its new summary and drop summaries nobody has now.

    Summaries are keyed by their text, so companies with equal ones share a node.
    """
    nodes, edges = graph
    companies = _label(nodes, fixed.COMPANY).select(
        "key", F.try_element_at("props", F.lit("name")).alias("name")
    )
    links = as_edges(
        split_join(companies, summaries, "name"), fixed.COMPANY, "key", fixed.HAS_SUMMARY, fixed.COMPANY_SUMMARY, "summary"
    )
    fresh = assign_props(
        links.select(F.col("dst_key").alias("summary")).distinct(), fixed.COMPANY_SUMMARY, "summary", ["summary"]
    )
    rel = fixed.HAS_SUMMARY
    after = replace_edges(edges, links, rel)
    nodes = merge_props(nodes, fresh, [fixed.COMPANY_SUMMARY])
    return drop_orphans(nodes, after, detached(edges, links, rel), rel, fixed.COMPANY_SUMMARY), after
