"""Readers for the record formats: JSON lines, text lines, tab-separated rows, documents, vocabularies."""

from __future__ import annotations

import ctypes
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.answers import extract_number
from quern.functions.text import strip, strip_lines
from quern.session import scratch_dir

MIB = 1 << 20
#: Bytes that one task of a digest over many rows reads, about.
PART_BYTES = 128 * MIB


def read_jsonl_dir(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every ``*.json`` / ``*.jsonl`` file below ``path``, with a declared schema (no inference pass).

    A line that is not a JSON object of that schema fails the read.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("mode", "FAILFAST")
    return reader.option("pathGlobFilter", "*.{json,jsonl}").json(path)


def read_text_lines(spark: SparkSession, path: str, keep_linebreaks: bool = True) -> DataFrame:
    """One row per line; with ``keep_linebreaks`` the newline stays on the text."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    text = F.concat("value", F.lit("\n")) if keep_linebreaks else F.col("value")
    return lines.select(text.alias("text"))


def read_named_tsv(spark: SparkSession, path: str, kind: str = "alpaca") -> DataFrame:
    """Header-less tab-separated rows; ``qa`` has two columns, anything else three."""
    names = ["input", "output"] if kind == "qa" else ["instruction", "input", "output"]
    schema = ", ".join(f"{n} string" for n in names)
    reader = spark.read.schema(schema).option("sep", "\t").option("header", False)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def extension_counts(df: DataFrame) -> DataFrame:
    """Rows per file extension of a file-backed table."""
    ext = F.lower(F.regexp_extract(F.input_file_name(), r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    return df.select(ext.alias("extension")).groupBy("extension").agg(F.count(F.lit(1)).alias("n_rows"))


def require_single_extension(df: DataFrame) -> DataFrame:
    """``df`` unchanged; raises when its files mix extensions (judged from the file list, not the rows)."""
    found = sorted({f.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower() for f in df.inputFiles()})
    if len(found) > 1:
        raise ValueError(f"mixed file types: {found}")
    return df


def first_words(lines: DataFrame, line: str = "text") -> DataFrame:
    """Distinct first words of the non-blank lines."""
    word = F.split(strip(F.col(line)), r"(?U)\s+")[0]
    return lines.where(F.length(strip(F.col(line))) > 0).select(word.alias("word")).distinct()


def word_frequencies(lines: DataFrame, line: str = "text") -> DataFrame:
    """``word freq …`` lines as a table; lines without an integer count are left out."""
    parts = F.split(strip(F.col(line)), r"(?U)\s+")
    out = lines.select(parts[0].alias("word"), F.get(parts, F.lit(1)).try_cast("bigint").alias("freq"))
    return out.where(F.col("freq").isNotNull())


def html_text(html: Column) -> Column:
    """Visible text of an HTML page."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?is)<script\b.*?</script>", "")
    t = F.regexp_replace(t, r"(?is)<style\b.*?</style>", "")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    # The character references that are decoded; the ampersand comes last.
    for ref, char in [("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]:
        t = F.replace(t, F.lit(ref), F.lit(char))
    return t


def document_lines(text: Column) -> Column:
    """Stripped, non-empty lines joined by a newline."""
    return F.array_join(strip_lines(text), "\n")


def prompt_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """One stripped prompt per line, blank lines kept, numbered within its source row."""
    out = df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "_line"))
    return out.select(key, F.col("line_no").cast("bigint").alias("line_no"), strip(F.col("_line")).alias("prompt"))


def fingerprint(content: Column) -> Column:
    """MD5 of the first MiB of a binary value."""
    return F.md5(F.substring(content, 1, MIB))


def _located(name: str, stores: dict[str, tuple[fs.FileSystem, str]]) -> tuple[fs.FileSystem, str]:
    """The file system of a full path and the path inside it."""
    scheme, host, inner = re.fullmatch(r"([A-Za-z][\w+.-]*):(?://([^/]*))?(/.*)", name, re.DOTALL).groups()
    root = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{host or ''}/"
    if root not in stores:
        stores[root] = fs.FileSystem.from_uri(root)
    store, base = stores[root]
    return store, base.rstrip("/") + inner


def _head(name: str, stores: dict[str, tuple[fs.FileSystem, str]]) -> bytes:
    store, inner = _located(name, stores)
    with store.open_input_file(inner) as f:
        return f.read(MIB)


def _heads(spark: SparkSession, path: str) -> DataFrame:
    """``path, head``: the first MiB of every file below ``path``; empty files are not listed.

    The scan lists files without reading them, and each task reads the first MiB of its own, however large they are. A
    store that Python cannot open (tried with one file) is read by Spark instead, which holds a file whole and takes
    none beyond 2 GB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = files.select("path")
    one = names.first()
    try:
        _head(one["path"], {}) if one else b""
    except (pa.ArrowException, OSError):
        return files.select("path", F.substring("content", 1, MIB).alias("head"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, tuple[fs.FileSystem, str]] = {}
        for b in batches:
            for name in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([_head(name, stores)])], ["path", "head"])

    return names.mapInArrow(read, "path string, head binary")


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Fingerprint of every file below ``path``."""
    return _heads(spark, path).select("path", fingerprint(F.col("head")).alias("fingerprint"))


class _Md5:
    """An MD5 whose state can be taken to another task, by the C library that Python's own one calls."""

    def __init__(self, state: bytes = b"") -> None:
        self.lib = _md5_library()
        self.state = ctypes.create_string_buffer(state, 256)
        if not state:
            self.lib.MD5_Init(self.state)

    def update(self, data: bytes) -> None:
        self.lib.MD5_Update(self.state, data, ctypes.c_size_t(len(data)))

    def hexdigest(self) -> str:
        digest = ctypes.create_string_buffer(16)
        self.lib.MD5_Final(digest, self.state)
        return digest.raw.hex()


def _md5_library() -> ctypes.CDLL | None:
    """The C library, or nothing where Python was built without it."""
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        return lib if lib.MD5_Init and lib.MD5_Update and lib.MD5_Final else None
    except (ImportError, AttributeError, OSError):
        return None


def set_fingerprint(heads: DataFrame, order: str, head: str) -> DataFrame:
    """``fingerprint, n``: one MD5 over the first MiB of every row's content, joined in the order of ``order``.

    A digest over a sequence is taken from front to back. The heads are written in parts of about ``PART_BYTES``, each a
    range of ``order``; the parts pass one task after another, and what goes from task to task is the state of the digest,
    some hundred bytes. Where Python has no digest whose state can be taken along, all heads pass one task.
    """
    spark = heads.sparkSession
    kinds = "fingerprint string, n bigint, state binary"

    def digest(state: bytes, before: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            md5, n = hashlib.md5() if whole else _Md5(state), before
            for b in batches:
                for value in b.column(1):
                    md5.update(value.as_py() or b"")
                    n += 1
            left = b"" if whole else md5.state.raw
            yield pa.RecordBatch.from_arrays(
                [pa.array([md5.hexdigest()]), pa.array([n], pa.int64()), pa.array([left], pa.binary())], ["fingerprint", "n", "state"]
            )

        return run

    def step(rows: DataFrame, state: bytes = b"", before: int = 0, whole: bool = False) -> DataFrame:
        return rows.repartition(1).sortWithinPartitions(order).mapInArrow(digest(state, before, whole), kinds)

    rows = heads.select(order, F.substring(F.col(head).cast("binary"), 1, MIB).alias("_h"))
    size = rows.select(F.sum(F.octet_length("_h"))).first()[0] or 0
    parts = -(-size // PART_BYTES)
    if parts <= 1 or _md5_library() is None:
        return step(rows, whole=True).drop("state")
    path = scratch_dir(spark, "heads")
    dealt = rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    dealt.write.partitionBy("_part").parquet(path)
    written = spark.read.schema(dealt.schema).parquet(path)
    state, n = b"", 0
    for i in range(parts - 1):
        row = step(written.where(F.col("_part") == i).drop("_part"), state, n).first()
        state, n = bytes(row["state"]), row["n"]
    return step(written.where(F.col("_part") == parts - 1).drop("_part"), state, n).drop("state")


def file_set_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """The fingerprint of the files below ``path`` as a set in the order of their names."""
    return set_fingerprint(_heads(spark, path), "path", "head")


#: Marks of a text in Markdown that are not part of its words: heading signs, emphasis, quotes, list bullets, fences.
MARKDOWN_MARKS = [r"(?m)^\s{0,3}#{1,6}\s+", r"(?m)^\s{0,3}>\s?", r"(?m)^\s*[-*+]\s+", r"(?m)^```.*$", r"\*\*|__|`"]
LINKS = r"!?\[([^\]]*)\]\([^)]*\)"
BLOCK_END = r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|blockquote|pre)\b[^>]*>"


def markdown_text(text: Column) -> Column:
    """Markdown without its marks; links keep their text."""
    out = F.regexp_replace(text, LINKS, "$1")
    for mark in MARKDOWN_MARKS:
        out = F.regexp_replace(out, mark, "")
    return out


def numeric_references(text: Column) -> Column:
    """``&#65;`` and ``&#x41;`` as the characters they name; numbers that name none stay."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)&#x?[0-9A-Fa-f]{1,6};|[^&]+|&"), F.lit(0))

    def char(p: Column) -> Column:
        hexed = F.lower(F.substring(p, 3, 1)) == "x"
        digits = F.regexp_replace(p, "^&#x?|;$", "")
        code = F.when(hexed, F.conv(digits, 16, 10).cast("bigint")).otherwise(digits.try_cast("bigint"))
        named = F.startswith(p, F.lit("&#")) & code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(named, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(p)

    return F.array_join(F.transform(parts, char), "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of every text, Markdown and HTML file below ``path``, one row per file, by its extension.

    Lines are stripped and empty ones left out. Block tags of HTML end a line; character references are decoded.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,md,html,htm}")
    raw = reader.text(path, wholetext=True)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), "value")
    page = numeric_references(html_text(F.regexp_replace("value", BLOCK_END, "\n$0")))
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    text = F.when(kind == "md", markdown_text(F.col("value"))).when(kind == "txt", F.col("value")).otherwise(page)
    return rows.select("path", document_lines(text).alias("text"))


def normalize_eval(df: DataFrame, key: str, dataset: str) -> DataFrame:
    """A benchmark table to ``sample_id, eval_dataset, question, ground_truth, ground_truth_value``.

    Column names vary between benchmarks; the first that exists wins. The value comes from ``result_float`` where
    the table has it, else from the solution text.
    """

    def first_of(*names: str) -> Column:
        have = [F.col(n) for n in names if n in df.columns]
        return F.coalesce(*have, F.lit("")) if have else F.lit("")

    if "result_float" in df.columns or "result" in df.columns:
        question, truth = first_of("question"), first_of("result").cast("string")
        value = F.col("result_float").cast("double") if "result_float" in df.columns else F.lit(None).cast("double")
    else:
        question = first_of("problem", "question")
        # The solution column's names, the first one misspelt as published.
        truth = first_of("groud_truth_solution", "ground_truth_solution")
        value = extract_number(truth)
    return df.select(
        F.col(key).alias("sample_id"),
        F.lit(dataset).alias("eval_dataset"),
        question.alias("question"),
        truth.alias("ground_truth"),
        value.alias("ground_truth_value"),
    )
