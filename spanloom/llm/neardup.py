"""Near-duplicate classes by Order MinHash with banded verification.

Equal texts are one node. Each node's sketch samples the smallest
occurrence-labelled five-word shingles and keeps them in text order
(ordersketch.py); nodes that share a band key are candidates, and a candidate
pair is linked if the banded alignment of their shingle sequences has an
ordered similarity of SIMILARITY or more. Classes are the connected components
of the links.

A bucket (the nodes of one band key) is never expanded into all its pairs.
All nodes are drawn in one order, and the first drawn of a bucket leads it. Every
node is compared with one leader only, that of most of its buckets, which links
a group of copies by at most one pair a node. Nodes of buckets that still hold
several components then meet through an exact positional prefix filter: in one
order of all shingles, rarest first, two texts of the required similarity share
one of their first few shingles, at places that leave room for enough common
ones. Only pairs of different components are formed, the most frequent
component of a shingle not being paired with itself, so no link that could join
two components is left out.

Null texts and texts without a word of letters or digits that equal no other
text are classes of their own; null and empty texts are never grouped. Repeated
rows are in one class, since their texts are equal; other columns, whatever
their names, play no part. Whole texts count, however long: all their shingles
are sketched and aligned. An empty table has no classes. The class id is the
smallest doc_id of the class (null ids apart); ties between rows of that id and
text are broken by keeping one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm import common, ordersketch

#: Rows of links and labels in a partition, once there are more than the cores need.
ROWS_PER_PART = 500_000


#: Links (two digests, about 400 bytes in a union-find) that one task joins up.
MAX_ONE_TASK_LINKS = 400_000
#: Digests (about 60 bytes each) are broadcast up to this many; beyond, the join is shuffled.
MAX_BROADCAST_ROWS = 200_000


def _small(side: DataFrame) -> DataFrame:
    """A broadcast of the side if a count shows that it is small."""
    return F.broadcast(side) if side.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else side


def _digest(text: str):
    return F.when(F.length(text) > 0, F.unhex(F.md5(F.col(text).cast("binary"))))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest of the text, null for null and empty texts), keys (one for each band; none without words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        none = np.zeros(0, np.int64)
        for batch in batches:
            nodes, rows = batch.column(1).to_pylist(), []
            for node, text in zip(nodes, batch.column(2).to_pylist()):
                keys = none if node is None else known.get(node)
                if keys is None:
                    words = ordersketch.words_of(text)
                    keys = ordersketch.band_keys(words) if words else none
                    if len(known) > 20_000:
                        known.clear()
                    known[node] = keys
                rows.append(keys)
            ends = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(row) for row in rows], out=ends[1:])
            keys = pa.ListArray.from_arrays(ends, np.concatenate(rows) if rows else none)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], ["doc_id", "node", "keys"])

    return common.by_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest("text").alias("node"), "text"), work, "doc_id long, node binary, keys array<long>")


def _shingled(texts: DataFrame) -> DataFrame:
    """node, shingles (the hashes of the text's shingles in order, 8 bytes each) of rows (node, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ordersketch.shingle_hashes(ordersketch.words_of(text)).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    return common.by_batches(texts.select("node", "text"), work, "node binary, shingles binary")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) with their similarity."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, ordersketch.Shingles(b"")
        for batch in batches:
            found = []
            for b, one, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if b != last:
                    last, known = b, ordersketch.Shingles(other)
                found.append(ordersketch.aligned(ordersketch.Shingles(one), known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    one, other = texts.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), texts.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "of_a", "of_b")
    return common.by_batches(joined, work, "a binary, b binary, similarity double")


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, label from links (a, b), by union-find: the larger root always hangs below the smaller."""
    above: dict[bytes, bytes] = {}

    def root(node: bytes) -> bytes:
        while (up := above.setdefault(node, node)) != node:
            above[node] = above[up]
            node = up
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            above[max(x, y)] = min(x, y)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([root(node) for node in nodes], pa.binary())], ["node", "label"])


def components(links: DataFrame) -> DataFrame:
    """node, label of every node that has links (a, b); label: the smallest node of its connected component.

    Up to MAX_ONE_TASK_LINKS links are joined up by one task. Beyond, labels
    spread along links and then jump to their label's label, until none changes;
    each round is cut to the shared folder.
    """
    links = common.cut(links.distinct())
    if links.count() <= MAX_ONE_TASK_LINKS:
        return common.cut(common.by_batches(links.select("a", "b").coalesce(1), _joined_up, "node binary, label binary"))
    both = common.cut(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct())
    parts = _parts(both, both.count())
    both = both.coalesce(parts)
    labels = common.cut(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")).coalesce(parts))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "label", F.lit(None).cast("binary").alias("before"))
        near = labels.select("node", "label", F.col("label").alias("before")).union(heard).groupBy("node").agg(F.min("label").alias("label"), F.max("before").alias("before"))
        of = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = near.join(of, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "before")
        new = common.cut(new.coalesce(parts))
        labels = new.select("node", "label")
        if not new.where("label <> before").limit(1).count():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _tokens(nodes: DataFrame) -> DataFrame:
    """node, n, token: the n occurrence-labelled shingles of rows (node, shingles)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ordersketch.labelled(np.frombuffer(one, np.uint64)).view(np.int64) for one in batch.column(1).to_pylist()]
            ends = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(one) for one in found], out=ends[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, np.concatenate([*found, np.zeros(0, np.int64)]))], ["node", "tokens"])

    listed = common.by_batches(nodes.select("node", "shingles"), work, "node binary, tokens array<long>")
    return listed.select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))


def _ranked(members: DataFrame, texts: DataFrame, labels: DataFrame | None) -> DataFrame:
    """node, n, token, place: the first shingles, rarest first, of the nodes of buckets with several components."""
    labelled = _labelled(members.select("key", "node"), labels)
    mixed = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("key")
    nodes = labelled.join(mixed, "key", "left_semi").select("node").distinct()
    tokens = common.cut(_tokens(nodes.join(texts, "node")))
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("often", F.lit(1)), "token"))
    ranked = tokens.join(often, "token", "left").withColumn("place", place)
    return common.cut(ranked.where((F.col("place") <= F.col("n") - F.ceil(ordersketch.SIMILARITY * F.col("n") - 1e-9) + 1) & F.col("often").isNotNull()).drop("often"))


def _joining(ranked: DataFrame, labels: DataFrame | None, first: bool) -> DataFrame:
    """Pairs (a, b) of different components that may be similar, by a shingle of their prefixes.

    first: of a shingle's main component only the node that has it earliest is
    paired; such nodes have the fewest rare shingles, so most of what belongs
    to the component is linked to it by them.
    """
    least = ordersketch.SIMILARITY
    rows = _labelled(ranked, labels)
    main = rows.groupBy("token", "label").agg(F.count("*").alias("rows"), F.min(F.struct("place", "node", "n")).alias("best"))
    main = main.groupBy("token").agg(F.max(F.struct("rows", "label", "best")).alias("main")).select("token", "main.label", "main.best")
    few = rows.join(main.select("token", F.col("label").alias("main")), "token").where("label <> main")
    few = few.select("token", F.col("node").alias("x"), F.col("label").alias("of"), F.col("n").alias("m"), F.col("place").alias("at"))
    others = main.select("token", "label", "best.*") if first else rows
    overlap = F.ceil(least / (1 + least) * (F.col("n") + F.col("m")) - 1e-9)
    room = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) + 1
    met = few.join(others, "token").where((F.col("of") != F.col("label")) & (room >= overlap))
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _parts(frame: DataFrame, rows: int) -> int:
    return max(2 * frame.sparkSession.sparkContext.defaultParallelism, rows // ROWS_PER_PART)


def _led(shared: DataFrame) -> DataFrame:
    """Pairs (a, b): every node with the leader of most of its buckets, if it isn't one itself there; of several, the first drawn."""
    times = shared.where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("times"))
    led = times.groupBy("node").agg(F.min(F.struct(-F.col("times"), F.xxhash64("leader"), "leader"))["leader"].alias("leader"))
    return led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, node) of docs, and the nodes' classes (node, label, class_id, first: the class's row that stays).

    Buckets are cut before the members meet them, so that a bucket of very many
    members is an uneven side of a plain join, which adaptive execution splits.
    """
    sketched = common.cut(sketches(docs))
    nodes = common.cut(
        sketched.where("node IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.max("keys").alias("keys"))
    )
    parts = _parts(nodes, ordersketch.BANDS * nodes.count())
    members = nodes.select("node", F.explode("keys").alias("key"))
    draw = F.struct(F.xxhash64("node").alias("draw"), "node")
    buckets = common.cut(members.groupBy("key").agg(F.min(draw)["node"].alias("leader"), F.count("*").alias("size")).where("size > 1").drop("size").coalesce(parts))
    shared = common.cut(members.join(buckets, "key").coalesce(parts))
    wanted = _small(common.cut(shared.select("node").distinct().coalesce(parts)))
    texts = common.cut(_shingled(docs.select(_digest("text").alias("node"), "text").join(wanted, "node", "left_semi").dropDuplicates(["node"])))

    alike = F.col("similarity") >= ordersketch.SIMILARITY
    done = common.cut(_verified(_led(shared), texts))
    links = done.where(alike).select("a", "b")
    labels = components(links) if links.limit(1).count() else None
    ranked = _ranked(shared, texts, labels)
    for earliest in (True, False):
        new = common.cut(_verified(_joining(ranked, labels, earliest).join(done, ["a", "b"], "left_anti"), texts))
        more = new.where(alike).select("a", "b")
        done = done.union(new)
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links)
    named = _labelled(nodes.select("node", "doc_id"), labels)
    best = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("first"))
    return sketched.select("doc_id", "node"), named.select("node", "label").join(best, "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every row of docs (doc_id, text)."""
    rows, found = classes(docs)
    return rows.join(found.select("node", "class_id"), "node", "left").select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id. Null and empty texts stay.

    Rows that go are found by their id and text, so the texts of those that
    stay aren't moved; only where an id and text that stay occur more than once
    are their rows brought together.
    """
    rows, found = classes(docs)
    node, number = common.fresh_name(docs, "node"), common.fresh_name(docs, "number")
    own_node, own_number = common.fresh_name(docs, "class_node"), common.fresh_name(docs, "class_number")
    key = [own_node, own_number]
    named = rows.where("node IS NOT NULL").join(found.select("node", "first"), "node")
    stays = (F.col("node") == F.col("first.node")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    named = common.cut(named.groupBy(F.col("node").alias(own_node), F.col("doc_id").alias(own_number)).agg(F.max(stays).alias("stays"), F.count("*").alias("times")))
    gone, repeated = _small(named.where("NOT stays").select(*key)), named.where("stays AND times > 1").select(*key)
    keyed = docs.withColumn(node, _digest("text")).withColumn(number, F.col("doc_id").cast("long"))
    same = (F.col(node) == F.col(own_node)) & F.col(number).eqNullSafe(F.col(own_number))
    kept = keyed.join(gone, same, "left_anti")
    if repeated.limit(1).count():
        once = _small(repeated)
        kept = kept.join(once, same, "left_anti").union(keyed.join(once, same, "left_semi").dropDuplicates([node]))
    return kept.select(docs.columns)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
