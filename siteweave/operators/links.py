"""Edges of a game document, all read off the document in one pass.

A link rule turns a parsed document into an array of links. Rules are joined into
one array, so a document is parsed, exploded and shuffled once for all its edges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_key, code_name, fixed, has_number, utc_year
from .graph import EDGE, as_edges, as_nodes, with_endpoints
from .joins import split_join
from .ranking import dedupe_first

# Fields of a landed document, as declared to the JSON reader.
DOCUMENT_SCHEMA = """
    id long, name string, url string, summary string, storyline string,
    total_rating double, first_release_date long, game_type int, category int, franchise long,
    genres array<struct<id: long, name: string>>,
    involved_companies array<struct<id: long, company: struct<id: long, name: string>>>,
    similar_games array<struct<id: long>>
"""
# The fields that a pass over documents uses.
DOCUMENT_FIELDS = """
    id long, total_rating double, first_release_date long, summary string, url string, game_type int, franchise long,
    genres array<struct<id: long, name: string>>,
    involved_companies array<struct<id: long, company: struct<id: long, name: string>>>,
    similar_games array<struct<id: long>>
"""
SIMILAR_SCHEMA = """
    id long,
    similar_games array<struct<id: long, name: string, url: string, cover: struct<url: string>>>
"""

LINK = "array<struct<rel_type: string, dst_label: string, dst_key: string, dst_name: string>>"


def _link(rel: str, label: str, key: Column, name: Column | None = None) -> Column:
    return F.struct(
        F.lit(rel).alias("rel_type"),
        F.lit(label).alias("dst_label"),
        as_key(key).alias("dst_key"),
        (F.lit(None).cast("string") if name is None else name).alias("dst_name"),
    )


def _one(guard: Column, link: Column) -> Column:
    return F.when(guard, F.array(link)).otherwise(F.array().cast(LINK))


def _each(items: str, link: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.transform(items, link), F.array().cast(LINK))


def released_in() -> Column:
    """A missing date and date 0 give no year."""
    date = F.col("first_release_date")
    return _one(has_number(date), _link(fixed.RELEASED_IN, fixed.RELEASE_YEAR, utc_year(date)))


def part_of_franchise() -> Column:
    return _one(
        has_number(F.col("franchise")),
        _link(fixed.PART_OF_FRANCHISE, fixed.FRANCHISE, F.col("franchise")),
    )


def has_type() -> Column:
    """Code 0 is a type; unknown codes are not."""
    name = code_name(F.col("game_type"))
    return _one(name.isNotNull(), _link(fixed.HAS_TYPE, fixed.GAME_TYPE, F.col("game_type"), name))


def has_genre() -> Column:
    return _each("genres", lambda g: _link(fixed.HAS_GENRE, fixed.GENRE, g["id"], g["name"]))


def involves_company() -> Column:
    """Entries without a company are skipped."""
    named = F.filter("involved_companies", lambda c: c["company"].isNotNull())
    return F.coalesce(
        F.transform(
            named,
            lambda c: _link(fixed.INVOLVES_COMPANY, fixed.COMPANY, c["company"]["id"], c["company"]["name"]),
        ),
        F.array().cast(LINK),
    )


def similar_to() -> Column:
    return _each("similar_games", lambda g: _link(fixed.SIMILAR_TO, fixed.GAME, g["id"]))


DOCUMENT_RULES = (released_in, part_of_franchise, has_type, has_genre, involves_company)

# What the links of a rule have in common: relationship and label of the target. A packed link names its rule by the place here.
KINDS = {
    released_in: (fixed.RELEASED_IN, fixed.RELEASE_YEAR),
    part_of_franchise: (fixed.PART_OF_FRANCHISE, fixed.FRANCHISE),
    has_type: (fixed.HAS_TYPE, fixed.GAME_TYPE),
    has_genre: (fixed.HAS_GENRE, fixed.GENRE),
    involves_company: (fixed.INVOLVES_COMPANY, fixed.COMPANY),
    similar_to: (fixed.SIMILAR_TO, fixed.GAME),
}
# What separates fields and links in a packed text, and stands for itself behind the first of these.
_ESCAPED = {"\x01": "\x01a", "\n": "\x01b", "\t": "\x01c"}


def pack_links(rules: Sequence[Callable[[], Column]]) -> Column:
    """The links of these rules as one text, null without any; those without a key are left out.

    A link is a line of the rule's place, key and, where it has one, name. As an array of structs a document's links
    take three times the bytes in a shuffle, and six times in a sort.
    """

    def escaped(text: Column) -> Column:
        for char, code in _ESCAPED.items():
            text = F.replace(text, F.lit(char), F.lit(code))
        return text

    def line(rule: Callable[[], Column]) -> Callable[[Column], Column]:
        begin = F.lit(f"{[*KINDS].index(rule)}\t")
        named = lambda x: F.coalesce(F.concat(F.lit("\t"), escaped(x["dst_name"])), F.lit(""))
        return lambda x: F.concat(begin, escaped(x["dst_key"]), named(x))

    lines = [F.transform(rule().cast(LINK), line(rule)) for rule in rules]
    return F.nullif(F.array_join(F.concat(*lines), "\n"), F.lit(""))


def fold_packed(docs: DataFrame, keys: Sequence[str] = (), wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Distinct links of the packed `_links` per `keys`, with their last landing: the keys, seq and the fields of a link.

    They are told apart as they are packed, and only what is left is taken apart. `wanted` picks by the relationship.
    """

    def plain(text: Column) -> Column:
        for char, code in reversed(_ESCAPED.items()):
            text = F.replace(text, F.lit(code), F.lit(char))
        return text

    rels, labels = (F.array(*[F.lit(k[i]) for k in KINDS.values()]) for i in (0, 1))
    lines = docs.select("*", F.explode(F.split("_links", "\n")).alias("_line"))
    if wanted is not None:
        lines = lines.filter(wanted(F.get(rels, F.substring_index("_line", "\t", 1).cast("int"))))
    folded = lines.groupBy(*keys, "_line").agg(F.max("seq").alias("seq"))
    fields = folded.select(*keys, "seq", F.split("_line", "\t").alias("_f"))
    kind = F.get("_f", F.lit(0)).cast("int")
    return fields.select(
        *keys,
        "seq",
        F.get(rels, kind).alias("rel_type"),
        F.get(labels, kind).alias("dst_label"),
        plain(F.get("_f", F.lit(1))).alias("dst_key"),
        plain(F.get("_f", F.lit(2))).alias("dst_name"),
    )


def document_links(
    docs: DataFrame, rules: Sequence[Callable[[], Column]] = DOCUMENT_RULES, seq: str | None = None
) -> DataFrame:
    """Distinct links of all documents: src_key, rel_type, dst_label, dst_key.

    With `seq`, a column that grows with every landing, the target's `dst_name` and
    the last landing `seq` come along. Repeated links are folded before the shuffle.
    """
    ends = ["src_key", "rel_type", "dst_label", "dst_key"]
    links = F.concat(*[rule().cast(LINK) for rule in rules])
    source = as_key(F.col("id")).alias("src_key")
    present = "src_key IS NOT NULL AND dst_key IS NOT NULL"
    if not seq:
        flat = docs.select(source, F.explode(links).alias("_l")).select("src_key", "_l.*")
        return flat.filter(present).select(*ends).distinct()
    return fold_links(docs.select(source, F.col(seq).alias("seq"), F.explode(links).alias("_l")))


def fold_links(exploded: DataFrame) -> DataFrame:
    """Distinct links with their last landing, from (src_key, seq, _l)."""
    flat = exploded.select("src_key", "seq", "_l.*").filter("src_key IS NOT NULL AND dst_key IS NOT NULL")
    return flat.groupBy("src_key", "rel_type", "dst_label", "dst_key", "dst_name").agg(F.max("seq").alias("seq"))


def known_links(links: DataFrame, ids: DataFrame) -> DataFrame:
    """Links of documents whose catalogue id is a node; `ids` are graph nodes."""
    known = ids.filter(F.col("label") == fixed.CATALOG_ID).select(F.col("key").alias("src_key"))
    return links.join(known, "src_key", "left_semi")


def link_edges(links: DataFrame, games: DataFrame) -> DataFrame:
    """Edges of the links' catalogue ids, and of the games with the same id.

    A game that does not exist only loses its own edges. `games` are graph nodes.
    A link that is there under two target names gives its edges twice.
    """
    gamed = games.filter(F.col("label") == fixed.GAME).select(
        F.col("key").alias("src_key"), F.lit(True).alias("_game")
    )
    sources = F.when(F.col("_game"), F.array(F.lit(fixed.CATALOG_ID), F.lit(fixed.GAME))).otherwise(
        F.array(F.lit(fixed.CATALOG_ID))
    )
    return (
        links.select("src_key", "rel_type", "dst_label", "dst_key")
        .join(gamed, "src_key", "left")
        .withColumn("src_label", F.explode(sources))
        .select(*EDGE)
    )


def link_targets(links: DataFrame) -> DataFrame:
    """Target nodes of the links; of several names the last landed one counts, none only if there is no name."""
    names = links.groupBy("dst_label", "dst_key", "dst_name").agg(F.max("seq").alias("seq"))
    named = dedupe_first(
        names, ["dst_label", "dst_key"], [F.col("dst_name").isNull(), F.col("seq").desc_nulls_last(), "dst_name"]
    )
    return named.select(
        F.col("dst_label").alias("label"),
        F.col("dst_key").alias("key"),
        F.col("dst_name").alias("name"),
    )


def document_edges(
    docs: DataFrame, ids: DataFrame, games: DataFrame, rules: Sequence[Callable[[], Column]] = DOCUMENT_RULES
) -> DataFrame:
    """Edges of all documents of known ids."""
    return link_edges(known_links(document_links(docs, rules), ids), games)


def similar_edges(links: DataFrame, nodes: DataFrame, bidirectional: bool = False) -> DataFrame:
    """Game-SIMILAR_TO->Game for the similar-game links whose two games exist."""
    pairs = links.filter(F.col("rel_type") == fixed.SIMILAR_TO)
    edges = as_edges(pairs, fixed.GAME, "src_key", fixed.SIMILAR_TO, fixed.GAME, "dst_key")
    if bidirectional:
        ends = F.array(
            F.struct("src_key", "dst_key"),
            F.struct(F.col("dst_key").alias("src_key"), F.col("src_key").alias("dst_key")),
        )
        both = edges.select(F.explode(ends).alias("_p")).select("_p.*")
        edges = as_edges(both, fixed.GAME, "src_key", fixed.SIMILAR_TO, fixed.GAME, "dst_key")
    return with_endpoints(edges, nodes)


def similar_by_name(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The older form, for a graph whose games are keyed by name: Catalog_ID -> Game.

    `docs` is in the similar-game schema; both ends must exist.
    """
    named = docs.select("id", F.explode("similar_games.name").alias("_name"))
    edges = as_edges(named, fixed.CATALOG_ID, "id", fixed.SIMILAR_TO, fixed.GAME, "_name")
    return with_endpoints(edges, nodes)


def attach_by_name(
    games: DataFrame, items: DataFrame, name: str, item_key: str, rel: str, item_label: str
) -> tuple[DataFrame, DataFrame]:
    """Attach items to every game of the item's game name.

    `games` has columns key and `name`; `items` has `name` and `item_key`. Returns
    the edges and the games to create for names no game has; such a game is keyed
    by its name. Each item meets each game of its name, so bound the items per name
    (top_k) before they come here.
    """
    named = items.filter(F.col(name).isNotNull()).select(name, item_key)
    owners = games.select(name, as_key(F.col("key")).alias("_owner"))
    homeless = split_join(named, games.select(name).distinct(), name, "left_anti")
    attached = split_join(owners, named, name).unionByName(homeless.withColumn("_owner", F.col(name)))
    edges = as_edges(attached, fixed.GAME, "_owner", rel, item_label, item_key)
    return edges, as_nodes(homeless.select(name).distinct(), fixed.GAME, name, [name])
