"""Graph export: nodes, edges, degrees, search text, communities, statistics and JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.text import basename, page_ref
from lakeloom.operators.dedup import _numbered
from lakeloom.plans.storage import discard, materialize


def chunk_files(chunks: DataFrame) -> DataFrame:
    """(chunk_id, filename, page) of the chunks' own files.

    Tables of the older generation have a chapter and a position in place of a file name, or neither.
    """
    if "filename" not in chunks.columns:
        key = F.col("chunk_id").cast("string")
        if "chapter" not in chunks.columns:
            return chunks.select(key.alias("chunk_id"), F.concat(F.lit("Chunk "), key).alias("filename"), F.lit("?").alias("page"))
        page = (F.col("chunk_index") + 1).cast("string") if "chunk_index" in chunks.columns else F.lit(None).cast("string")
        chapter = F.concat(F.lit("Chapter "), F.coalesce(F.col("chapter").cast("string"), F.lit("?")))
        return chunks.select(key.alias("chunk_id"), chapter.alias("filename"), F.coalesce(page, F.lit("?")).alias("page"))
    return chunks.select(F.col("chunk_id").cast("string").alias("chunk_id"), page_ref(F.col("filename")).alias("p")).select("chunk_id", "p.filename", "p.page")


def entity_files(entities: DataFrame, files: DataFrame) -> DataFrame:
    """(entity_id, files): the (filename, page) of an entity's documents in order, each file once; unknown ids stand for themselves."""
    seen = entities.select("entity_id", F.posexplode("documents_appeared").alias("nth", "chunk_id"))
    known = seen.join(files, "chunk_id", "left").select("entity_id", "nth", F.coalesce("filename", "chunk_id").alias("filename"), F.coalesce("page", F.lit("?")).alias("page"))
    first = known.groupBy("entity_id", "filename").agg(F.min(F.struct("nth", "page")).alias("f"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col("f.nth").alias("nth"), "filename", F.col("f.page").alias("page")))), lambda x: F.struct(x["filename"].alias("filename"), x["page"].alias("page")))
    return first.groupBy("entity_id").agg(listed.alias("files"))


def _first_files(entities: DataFrame, files: DataFrame) -> DataFrame:
    first = files.select(F.col("chunk_id").alias("first_seen_document"), F.col("filename").alias("first_path"), F.col("page").alias("first_page"))
    e = entities.join(first, "first_seen_document", "left")
    return e.withColumn("first_path", F.coalesce("first_path", F.when(F.col("first_seen_document") != "", F.col("first_seen_document")), F.lit("unknown"))).withColumn("first_page", F.coalesce("first_page", F.lit("?")))


def _main(entities: DataFrame) -> DataFrame:
    """(name, a): the attributes of each name's row with most files (the first of these)."""
    attributes = F.struct(F.coalesce("type", F.lit("unknown")).alias("entity_type"), F.coalesce("description", F.lit("")).alias("description"), "first_path", "first_page")
    return entities.groupBy("name").agg(F.max_by(attributes, F.struct("n_files", -F.col("entity_id"))).alias("a"))


def node_attributes(entities: DataFrame, files: DataFrame) -> DataFrame:
    """(name, entity_type, description) of ``nodes``: files are only counted, by sums that combine before the shuffle."""
    seen = entities.select("entity_id", F.explode("documents_appeared").alias("chunk_id")).join(files.select("chunk_id", "filename"), "chunk_id", "left")
    n = seen.select("entity_id", F.coalesce("filename", "chunk_id").alias("filename")).distinct().groupBy("entity_id").agg(F.count("*").cast("int").alias("n_files"))
    e = _first_files(entities.drop("documents_appeared").join(n, "entity_id", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0))), files)
    return _main(e).select("name", "a.entity_type", "a.description")


def nodes(entities: DataFrame, files: DataFrame) -> DataFrame:
    """One node a name: attributes of its row with most files (the first of these), files of all rows in order."""
    none = F.array().cast("array<struct<filename:string,page:string>>")
    e = _first_files(entities.join(entity_files(entities, files), "entity_id", "left").withColumn("files", F.coalesce("files", none)), files)
    main = _main(e.withColumn("n_files", F.size("files")))
    every = e.select("name", "entity_id", F.posexplode("files").alias("nth", "f")).groupBy("name", "f.filename").agg(F.min(F.struct("entity_id", "nth", "f.page")).alias("o"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("o.entity_id", "o.nth", "filename", "o.page"))), lambda x: F.struct(x["filename"].alias("filename"), x["page"].alias("page")))
    docs = every.groupBy("name").agg(listed.alias("documents"))
    out = main.join(docs, "name", "left").withColumn("documents", F.coalesce("documents", none))
    return out.select("name", "a.entity_type", "a.description", F.size("documents").alias("document_count"), basename(F.col("a.first_path")).alias("first_seen_display"), F.col("a.first_page").alias("first_seen_page"), "documents")


def _between(rels: DataFrame, node_names: DataFrame) -> DataFrame:
    """Relationships whose ends are nodes, the lesser end first."""
    given = rels.where("source is not null and source <> '' and target is not null and target <> ''")
    both = given.join(node_names.select(F.col("name").alias("source")), "source", "left_semi").join(node_names.select(F.col("name").alias("target")), "target", "left_semi")
    return both.withColumns({"source": F.least("source", "target"), "target": F.greatest("source", "target")})


def weights(rels: DataFrame, node_names: DataFrame) -> DataFrame:
    """(source, target, weight) of ``edges``: counts that combine before the shuffle."""
    return _between(rels, node_names).groupBy("source", "target").agg(F.count("*").alias("weight"))


def edges(rels: DataFrame, node_names: DataFrame, keep: int = 5) -> DataFrame:
    """(source, target, weight, relationships): unordered pairs of nodes, the first ``keep`` relationships by id."""
    row = _between(rels, node_names).select(
        "source", "target", "relationship_id",
        F.struct(F.coalesce("type", F.lit("unknown")).alias("type"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("document_id", F.lit("?")).alias("document_id")).alias("r"),
    )
    weight = row.groupBy("source", "target").agg(F.count("*").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("source", "target").orderBy("relationship_id", "r"))
    first = row.withColumn("n", rank).where(F.col("n") <= keep).groupBy("source", "target").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "r"))), lambda x: x["r"]).alias("relationships"))
    return weight.join(first, ["source", "target"])


def degrees(edge_table: DataFrame) -> DataFrame:
    """Sum of the weights at each end; a loop counts twice."""
    return edge_table.select(F.explode(F.array("source", "target")).alias("name"), "weight").groupBy("name").agg(F.sum("weight").alias("connections"))


def with_degrees(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    return node_table.join(degrees(edge_table), "name", "left").withColumn("connections", F.coalesce("connections", F.lit(0)))


def search_text(node_table: DataFrame, entities: DataFrame, documents: DataFrame, rels: DataFrame) -> DataFrame:
    """(name, search_text): name, type and description, the fields of the entity's documents, its relationships; lower case."""
    full = lambda c: F.filter(F.array(*c), lambda x: x.isNotNull() & (x != ""))
    seen = entities.select("name", F.explode("documents_appeared").alias("document_id"))
    d = seen.join(documents, "document_id").select("name", F.array_join(full(["subject", "sender", "recipient", "reference"]), " ").alias("t")).where("t <> ''").distinct()
    d = d.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("t")), " ").alias("d"))
    r = rels.select(F.explode(F.array_distinct(F.array("source", "target"))).alias("name"), F.array_join(full(["type", "description"]), " ").alias("t")).where("t <> ''").distinct()
    r = r.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("t")), " ").alias("r"))
    own = node_table.select("name", F.array_join(full(["name", "entity_type", "description"]), " ").alias("o"))
    return own.join(d, "name", "left").join(r, "name", "left").select("name", F.lower(F.concat_ws(" ", "o", "d", "r")).alias("search_text"))


def type_counts(node_table: DataFrame) -> DataFrame:
    return node_table.groupBy("entity_type").agg(F.count("*").alias("n"))


def top_connected(node_table: DataFrame, n: int = 10) -> DataFrame:
    return node_table.orderBy(F.desc("connections"), "name").limit(n).select("name", "entity_type", "connections")


def graph_stats(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    n = node_table.agg(F.count("*").alias("node_count")).withColumn("k", F.lit(1))
    e = edge_table.agg(F.count("*").alias("edge_count"), F.coalesce(F.sum("weight"), F.lit(0)).alias("relationship_count")).withColumn("k", F.lit(1))
    return n.join(e, "k").drop("k")


def _coin(c: Column, turn: int) -> Column:
    """Whether a community waits in this round (others may join it), by a hash of its name and the round."""
    return F.substring(F.md5(F.concat(F.lit(f"{turn}:"), c).cast("binary")), 1, 1) < "8"


def _proposals(links: DataFrame, total: float, turn: int) -> DataFrame:
    """(tail, head, st, sh, gain): each moving community's best waiting neighbour, if joining it raises the modularity."""
    gain = F.col("w") * total - F.col("sa") * F.col("sb")
    a_waits = _coin(F.col("a"), turn)
    live = links.where((gain > 0) & (a_waits != _coin(F.col("b"), turn))).select(
        F.when(a_waits, F.col("b")).otherwise(F.col("a")).alias("tail"),
        F.struct(gain.alias("gain"), F.when(a_waits, F.col("a")).otherwise(F.col("b")).alias("head"), F.when(a_waits, F.col("sb")).otherwise(F.col("sa")).alias("st"), F.when(a_waits, F.col("sa")).otherwise(F.col("sb")).alias("sh")).alias("to"),
    )
    return live.groupBy("tail").agg(F.max("to").alias("to")).select("tail", "to.*")


def _merges(proposals: DataFrame) -> DataFrame:
    """(c, into, s): what joins what, and the strength of the whole.

    Of the tails that ask for one head those join whose gain outweighs half of what they cost each other; the sum of
    their gains is then positive.  The one that comes nearest to that joins even if none does; it would be among them otherwise.
    """
    strength, cost = F.col("st"), F.col("others") - F.col("st")
    asked = proposals.groupBy("head").agg(F.sum("st").alias("others"), F.max(F.struct(F.col("gain") / strength + strength / 2, "tail")).alias("best"))
    fits = (F.col("gain") > strength * cost / 2) | (F.col("tail") == F.col("best.tail"))
    joined = proposals.join(asked, "head").where(fits).select("tail", "head", "st", "sh")
    whole = joined.groupBy("head").agg((F.sum("st") + F.max("sh")).alias("s"))
    tails = joined.join(whole, "head").select(F.col("tail").alias("c"), F.col("head").alias("into"), "s")
    return tails.unionByName(whole.select(F.col("head").alias("c"), F.col("head").alias("into"), "s"))


def _contracted(links: DataFrame, merges: DataFrame) -> DataFrame:
    """The links between the communities after the merges."""
    for side in ("a", "b"):
        to = merges.select(F.col("c").alias(side), F.col("into").alias("_into"), F.col("s").alias("_s"))
        links = links.join(to, side, "left").withColumns({side: F.coalesce("_into", side), f"s{side}": F.coalesce("_s", f"s{side}")}).drop("_into", "_s")
    turned = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    links = links.where("a <> b").select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("sa", "sb").alias("sa"), pick("sb", "sa").alias("sb"), "w")
    return links.groupBy("a", "b").agg(F.sum("w").alias("w"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))


def _relabelled(labels: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(name, label) after some rounds of merges."""
    for merges in steps:
        labels = labels.join(merges.select(F.col("c").alias("label"), "into"), "label", "left").select("name", F.coalesce("into", "label").alias("label"))
    return labels


def communities(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """(name, community) by rounds of merges, each of which raises the modularity, until no two linked communities gain by merging.

    In a round a hash says of each community whether it waits or moves; a moving one asks its best waiting neighbour
    (largest gain, then largest name).  All steps are joins and sums that combine before the shuffle; only the total weight and
    whether anything is left to merge reach the driver, and the same steps run at every size.
    Communities are numbered by size, then by their least name; a node without links is one of its own.
    """
    labels = node_table.select("name", F.col("name").alias("label")).distinct()
    strength = degrees(edge_table).select("name", F.col("connections").cast("double").alias("s"))
    total = strength.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("t")).first()["t"]
    first = edge_table.where("source <> target").select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"), F.col("weight").cast("double").alias("w"))
    first = first.groupBy("a", "b").agg(F.sum("w").alias("w"))
    for side in ("a", "b"):
        first = first.join(strength.select(F.col("name").alias(side), F.col("s").alias(f"s{side}")), side)
    links, turn, steps = materialize(first, "links"), 0, []
    while True:
        asked = materialize(_proposals(links, total, turn), "proposals")
        turn += 1
        if asked.isEmpty():
            discard(asked)
            if links.where(F.col("w") * total > F.col("sa") * F.col("sb")).isEmpty():
                break
            continue  # all that could gain are on one side of the coin
        steps.append(materialize(_merges(asked), "merges"))
        before = links
        links = materialize(_contracted(links, steps[-1]), "links")
        discard(asked, before)
        if len(steps) == 8:
            old, labels, steps = (labels, *steps), materialize(_relabelled(labels, steps), "labels"), []
            discard(*old)
    discard(links)
    labels = materialize(_relabelled(labels, steps), "labels")
    discard(*steps)
    sizes = labels.groupBy("label").agg((-F.count("*")).alias("less"), F.min("name").alias("least"))
    ids = _numbered(sizes, ["less", "least"], "community")
    return labels.join(ids, "label").select("name", F.col("community").cast("int").alias("community"))


def modularity(edge_table: DataFrame, found: DataFrame) -> DataFrame:
    """(modularity): the weight inside communities over all, less what their strengths would give by chance; null without weight."""
    total = degrees(edge_table).agg(F.sum("connections").cast("double").alias("total"))
    at = degrees(edge_table).join(found, "name").groupBy("community").agg(F.sum("connections").cast("double").alias("s"))
    ends = edge_table.join(found.select(F.col("name").alias("source"), F.col("community").alias("x")), "source").join(found.select(F.col("name").alias("target"), F.col("community").alias("y")), "target")
    inside = ends.where("x = y").agg(F.coalesce(F.sum(F.col("weight").cast("double")) * 2, F.lit(0.0)).alias("inside"))
    one = inside.withColumn("k", F.lit(1))
    for part in (total, at.agg(F.sum(F.col("s") * F.col("s")).alias("squares"))):
        one = one.join(part.withColumn("k", F.lit(1)), "k")
    return one.select((F.col("inside") / F.col("total") - F.col("squares") / (F.col("total") * F.col("total"))).alias("modularity"))


def community_summary(node_table: DataFrame, found: DataFrame, top: int = 5) -> DataFrame:
    """(community, size, top_entities): the members with most connections."""
    m = node_table.select("name", "connections").join(found, "name")
    rank = F.row_number().over(Window.partitionBy("community").orderBy(F.desc("connections"), "name"))
    first = m.withColumn("n", rank).where(F.col("n") <= top).groupBy("community").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "name"))), lambda x: x["name"]).alias("top_entities"))
    return m.groupBy("community").agg(F.count("*").alias("size")).join(first, "community")


def top_communities(summary: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest communities; ties to the lesser number."""
    return summary.orderBy(F.desc("size"), "community").limit(n)


def export_tables(node_table: DataFrame, edge_table: DataFrame, path: str) -> None:
    """The graph as three folders of JSON lines in any store that Spark writes: nodes, links and stats."""
    for name, df in (("nodes", node_table), ("links", edge_table), ("stats", graph_stats(node_table, edge_table))):
        df.write.mode("errorifexists").json(f"{path.rstrip('/')}/{name}")


def export_json(node_table: DataFrame, edge_table: DataFrame, path: str) -> None:
    """One JSON document of nodes, links and statistics for a viewer, in a file of the driver.

    Rows pass the driver one partition at a time, so its memory does not grow with the graph.
    """
    stats = json.loads(graph_stats(node_table, edge_table).select(F.to_json(F.struct("*"))).first()[0])
    stats["type_counts"] = {r["entity_type"]: r["n"] for r in type_counts(node_table).orderBy(F.desc("n"), "entity_type").collect()}
    with open(path, "w", encoding="utf-8") as f:
        f.write("{")
        for key, df in (("nodes", node_table.orderBy("name")), ("links", edge_table.orderBy("source", "target"))):
            f.write(f'"{key}": [')
            for i, r in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
                f.write((", " if i else "") + r[0])
            f.write("], ")
        f.write(f'"stats": {json.dumps(stats, ensure_ascii=False)}}}')
