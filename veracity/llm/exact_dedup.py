"""Exact dedup (13): a stream of documents against keyed state on disk that never expires.

The state has one entry per digest: number of documents, the identifier that stays and the
locator of its content (file and row).  It lies in RocksDB and is saved to the shared
checkpoint folder with every micro-batch, so later files, or a run after a failure, go on
from it.  Documents whose digest the state holds for another one are hits; their full texts
are compared with the text at the locator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint
from veracity.session import ensure_checkpoint_dir

#: Bytes of input of a micro-batch.
BATCH = 64 << 30
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A digest with this share of all documents has a part of its own per ``SHARE`` documents.
HOT = 1000
SHARE = 4096
#: Slots of hit digests; the set of slots is broadcast, so this bounds it (8 MB).
SLOTS = 1 << 20


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Identifier, text (null: empty) and locator of every row of a Parquet table or stream."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"))


def ingest(spark: SparkSession, path: str, state: str, id_col: str = "doc_id", text_col: str = "text",
           digest=sha256, batch: int = BATCH) -> None:
    """Take all files at ``path`` (a glob or folder) that the state does not know yet into it.

    The stream stops when it has read what is there.  It runs in a session of its own, which
    alone has the state store on disk; ``state`` must be a folder that the cluster shares.
    A repeated row counts again; of equal identifiers with equal texts the one that comes
    last by file and row stays.  Null identifiers come before all others.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a batch opens each part of the state once: without this all stay open on disk and in memory
    session.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    schema = spark.read.parquet(path).select(id_col, text_col).schema
    docs = session.readStream.schema(schema).option("maxBytesPerTrigger", str(batch)).parquet(path)
    rows = located(docs, id_col, text_col).select(digest(F.col("text")).alias("digest"), "doc_id", "at")
    ledger = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "at")).alias("stays"))
    query = (ledger.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def ledger(spark: SparkSession, state: str) -> DataFrame:
    """What the state holds: ``digest, group_size, stays`` (identifier and locator)."""
    entries = spark.read.format("statestore").load(state)
    return entries.select("key.digest", F.col("value.count").alias("group_size"), F.col("value.max").alias("stays"))


def _looked_up(rows: DataFrame, entries: DataFrame, total: int) -> DataFrame:
    """``rows`` with the entry of their digest.

    Entries of a thousandth of all documents or more are at most a thousand, so they are
    broadcast, and their rows are dealt by their locator in the join with the others.
    """
    hot = entries.where(F.col("group_size") * HOT >= total)
    cold = entries.where(F.col("group_size") * HOT < total)
    first = hot.select(F.col("digest").alias("_hd"), F.struct("group_size", "stays").alias("_hot"))
    rest = cold.select(F.col("digest").alias("_cd"), F.struct("group_size", "stays").alias("_cold"))
    got = rows.join(F.broadcast(first), F.col("digest") == F.col("_hd"), "left")
    # no digest of the cold entries begins with a sharp
    key = F.when(F.col("_hd").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("at").cast("string")))
    got = got.withColumn("_key", key).join(rest, F.col("_key") == F.col("_cd"), "left")
    entry = F.coalesce("_hot", "_cold")
    return got.select(*rows.columns, entry["group_size"].alias("group_size"), entry["stays"].alias("stays"))


def _confirmed(docs: DataFrame, hits: DataFrame, digest) -> DataFrame:
    """Locators of the hits whose full text is not the text that stays; those are few, or none.

    Only texts of a digest with a hit move: a set of slots of such digests, whose size
    does not depend on the data, sorts out the others before.  The copies of a group are dealt in
    shares, and the text that stays goes to each share.
    """
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS))
    slots = hits.select(slot.alias("_slot")).distinct()
    texts = docs.withColumn("digest", digest(F.col("text"))).withColumn("_slot", slot)
    texts = texts.join(F.broadcast(slots), "_slot", "left_semi").select("digest", "at", "text")
    last = F.floor(F.col("group_size") / SHARE)
    own = F.pmod(F.xxhash64("at"), last + 1)
    # rows to fetch: every hit, for its share, and the text that stays, for every share of its group
    members = hits.select("digest", "at", F.array(own).alias("_shares"), F.lit(False).alias("_stays"))
    stays = hits.groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max("stays").alias("stays")).select(
        "digest", F.col("stays.at").alias("at"), F.sequence(F.lit(0).cast("long"), last).alias("_shares"), F.lit(True).alias("_stays"))
    wanted = members.unionByName(stays).select(
        F.col("digest").alias("_d"), F.col("at").alias("_at"), "_shares", "_stays")
    got = texts.join(wanted, (F.col("digest") == F.col("_d")) & (F.col("at") == F.col("_at")))
    got = got.select("digest", "at", "text", "_stays", F.explode("_shares").alias("_share"))
    kept = got.where("_stays").select("digest", "_share", F.col("text").alias("_kept"))
    member = got.where("NOT _stays").select("digest", "_share", "at", "text")
    return member.join(kept, ["digest", "_share"]).where(F.col("text") != F.col("_kept")).select("digest", "at", "text")


def verdicts(docs: DataFrame, entries: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per document: ``doc_id, at, digest, text_sha256, keep_id, group_size, kept``.

    ``entries`` is the ledger of these documents.  Texts are equal if all their bytes are:
    every hit is compared with the text that stays, and texts that share a digest
    without being equal (a collision) are grouped by the text itself.
    """
    rows = located(docs, id_col, text_col)
    total = entries.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("n")).first()["n"]
    narrow = rows.select("doc_id", "at", digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("text_sha256"))
    judged = checkpoint(_looked_up(narrow, entries, total))
    me = F.struct("doc_id", "at")
    hits = judged.where((F.col("group_size") > 1) & (F.col("stays") != me)).select("digest", "at", "group_size", "stays")
    other = checkpoint(_confirmed(rows, hits, digest))
    out = judged.select("doc_id", "at", "digest", "text_sha256", F.col("stays.doc_id").alias("keep_id"), "group_size",
                        (F.col("stays") == me).alias("kept"))
    if other.isEmpty():
        return out
    # collisions: the same again for them, by their whole text, and out of the count of their digest
    lost = other.groupBy(F.col("digest").alias("_d")).agg(F.count(F.lit(1)).alias("_lost"))
    left = out.join(other.select(F.col("at").alias("_at")), F.col("at") == F.col("_at"), "left_anti")
    left = left.join(lost, F.col("digest") == F.col("_d"), "left").withColumn(
        "group_size", F.col("group_size") - F.coalesce("_lost", F.lit(0)))
    ids = out.select(F.col("at").alias("_at"), "doc_id", "text_sha256")
    own = other.join(ids, F.col("at") == F.col("_at")).select("doc_id", "at", "digest", "text_sha256", "text")
    groups = own.groupBy(F.col("text").alias("_t"), F.col("digest").alias("_d")).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(me).alias("stays"))
    again = own.join(groups, (F.col("text") == F.col("_t")) & (F.col("digest") == F.col("_d")))
    again = again.withColumn("keep_id", F.col("stays.doc_id")).withColumn("kept", F.col("stays") == me)
    return left.select(*out.columns).unionByName(again.select(*out.columns))


def dedup(spark: SparkSession, path: str, state: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          digest=sha256, batch: int = BATCH) -> DataFrame:
    """Ingest the Parquet files at ``path`` and judge every document of them, dropped ones too.

    Of equal texts the row with the largest identifier stays (of equal ones the last by file and
    row, so one row stays); null texts are empty.  Without ``state`` the state begins empty in
    the shared checkpoint folder; with one, ``path`` must hold all files that went into it.
    Other columns are not read.  An empty table gives an empty result.
    """
    state = state or f"{ensure_checkpoint_dir(spark)}/exact-dedup-{uuid.uuid4().hex}"
    ingest(spark, path, state, id_col, text_col, digest, batch)
    return verdicts(spark.read.parquet(path), ledger(spark, state), id_col, text_col, digest)
