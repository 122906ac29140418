"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash, with DataFrame functions only.

The first scan takes a text's length in bytes and the hash of its first characters, as the reader hands both out at once,
and counts the pairs. Pairs that occur more than once mark slots of a bit map of fixed size, which travels to the second
scan; there only a text whose slot is marked is hashed whole. Texts of equal length and SHA-256 are one group. A slot
that two pairs share merely lets a text be hashed that would not have needed it.

Nulls: a null text counts as empty, a null id comes before every other. Repeated rows of one id are copies like any
other: of equal texts exactly one row stays, the one with the largest id, and among rows of that id any one. An empty
table gives an empty table. Texts may be of any length, and are never shuffled unless the caller keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import lookup_join, replaced, written

#: Characters of a text that its prefix hash covers.
PREFIX = 64
#: Slots of the bit map: 64 of them are one row, so at most 262 144 narrow rows are broadcast.
SLOT_BITS = 24
ADDED = ("keep_id", "group_size", "kept")
KEYS = ["_q_len", "_q_full"]

ORACLE = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)"""


def _content(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _slot() -> Column:
    return F.pmod(F.xxhash64("_q_len", "_q_head"), F.lit(1 << SLOT_BITS))


def _word(slot: Column) -> Column:
    return F.shiftright(slot, 6)


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))


def shared_slots(heads: DataFrame) -> DataFrame:
    """``_q_word, _q_bits``: the bit map of slots that hold a length and prefix hash of more than one row."""
    slot = _slot()
    return heads.filter("n > 1").groupBy(_word(slot).alias("_q_word")).agg(F.bit_or(_bit(slot)).alias("_q_bits"))


def group_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row with ``keep_id``, ``group_size`` and ``kept``, and with ``text`` if asked.

    A hot group is counted in the tasks before any exchange and met by :func:`lookup_join`. With ``keep_text`` texts of
    groups are part of the written rows; without it only the other columns are.
    """
    content = _content(text)
    sized = replaced(docs, ADDED).withColumns(
        {"_q_len": F.octet_length(content), "_q_head": F.xxhash64(F.substring(content, 1, PREFIX))}
    )
    heads = written(sized.groupBy("_q_len", "_q_head").agg(F.count(F.lit(1)).alias("n")), "heads")
    met = sized.withColumn("_q_word", _word(_slot())).join(F.broadcast(shared_slots(heads)), "_q_word", "left")
    shared = F.col("_q_bits").bitwiseAND(_bit(_slot())) != 0
    read = met.withColumn("_q_full", F.when(shared, F.sha2(content, 256))).withColumn("_q_row", F.monotonically_increasing_id())
    read = read.drop("_q_word", "_q_bits", "_q_head") if keep_text else read.drop("_q_word", "_q_bits", "_q_head", text)
    rows = written(read, "copies")

    survivors = rows.filter("_q_full is not null")
    stays = F.max(F.struct(F.col(key).alias("id"), F.col("_q_row").alias("row"))).alias("_q_stays")
    groups = written(survivors.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_q_n"), stays).filter("_q_n > 1"), "groups")
    alone = F.col("_q_n").isNull()
    grouped = lookup_join(survivors, groups, KEYS).withColumns({
        "keep_id": F.when(alone, F.col(key)).otherwise(F.col("_q_stays.id")),
        "group_size": F.coalesce("_q_n", F.lit(1)).cast("long"),
        "kept": alone | (F.col("_q_stays.row") == F.col("_q_row")),
    })
    single = rows.filter("_q_full is null").withColumns(
        {"keep_id": F.col(key), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    names = [*(c for c in rows.columns if not c.startswith("_q_")), *ADDED]
    return single.select(*names).unionByName(grouped.withColumn("kept", F.coalesce("kept", F.lit(False))).select(*names))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    own = {c: f"_o_{c}" for c in docs.columns if c.lower() in ADDED}
    out = group_copies(docs.withColumnsRenamed(own), key, text).filter("kept")
    return out.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))
