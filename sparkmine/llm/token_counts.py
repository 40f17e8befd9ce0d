"""Operator 7: token counts by a separator scan over flat token files.

The files have no index: documents are runs of token ids that end with a
separator id.  Every block of a file is searched with one vectorised comparison,
which gives its separators, the tokens before the first one and those after the
last one.  A document may span blocks; a prefix scan over the (few, small) block
summaries of a file adds the tokens that earlier blocks left open.

Files are bounded by ``DOCS_PER_FILE`` documents, and one task reads one file at
a time.  The folder of a token file names the input file and the row number in it of
its first document, the others follow in order, so documents and counts meet by
stored places that do not depend on how a scan was split; a total that differs raises.

Defined cases: consecutive separators are documents of 0 tokens; tokens after a
file's last separator form an unterminated document; empty files give no rows.
For tables: null and empty texts are documents of 0 tokens; repeated rows are
counted row by row.  A table that does not give file places is written once first.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.llm import tokenfiles as TF
from sparkmine.llm.common import documents
from sparkmine.session import cut_lineage, cut_lineage_observed, ensure_checkpoint_dir

#: Tokens searched at once.
BLOCK = 1 << 20
DOCS_PER_FILE = 2_000
_SUMMARY = "file string, block long, n_separators long, head long, tail long, inner array<long>"


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, source, row): each row with its file's hash and its number in that file."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    place = [F.xxhash64("_metadata.file_path").alias("source"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *place)
    except AnalysisException:
        return cut_lineage(own).select("doc_id", "text", *place)


def write_token_files(placed: DataFrame, path: str, tokenizer: str = TF.TOKENIZER, end: int = TF.END_OF_DOCUMENT, dtype: str = "uint16") -> None:
    """Tokenise every text of ``placed`` (text, source, row) and write flat files
    ``source=<s>/first=<r>/part-*``: the documents of rows r, r + 1, ... of source s."""
    kind, most = np.dtype(TF.DTYPES[dtype]).newbyteorder("<"), DOCS_PER_FILE

    def run(batches):
        last, first = None, 0
        for batch in batches:
            source, row = (batch.column(j).to_numpy(zero_copy_only=False) for j in (1, 2))
            firsts = []
            for s, r in zip(source.tolist(), row.tolist()):
                if last != (s, r - 1) or r - first >= most:
                    first = r
                last = (s, r)
                firsts.append(first)
            body = [ids.astype(kind).tobytes() for ids in TF.bpe_ids(batch.column(0), tokenizer)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(firsts, pa.int64()), batch.column(2), pa.array(body, pa.binary())], ["source", "first", "row", "value"])

    flat = placed.select("text", "source", "row").mapInArrow(run, "source long, first long, row long, value binary")
    TF.write_flat(flat.sortWithinPartitions("source", "first", "row").select("source", "first", "value"), path, np.array([end], kind).tobytes(), partition_by=["source", "first"])


def _scan(end: int, dtype: str, block: int):
    kind = np.dtype(TF.DTYPES[dtype]).newbyteorder("<")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                tokens = np.frombuffer(data, kind, len(data) // kind.itemsize)
                cols = [[], [], [], [], []]
                for b, lo in enumerate(range(0, len(tokens), block)):
                    part = tokens[lo : lo + block]
                    at = np.flatnonzero(part == end)
                    head, tail = (at[0], len(part) - 1 - at[-1]) if len(at) else (0, len(part))
                    for c, x in zip(cols, (b, len(at), head, tail, np.diff(at) - 1)):
                        c.append(x)
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cols[0]), pa.string()), *(pa.array(c, t) for c, t in zip(cols, kinds))], ["file", "block", "n_separators", "head", "tail", "inner"])

    return run


def token_counts(spark: SparkSession, path: str, end: int = TF.END_OF_DOCUMENT, dtype: str = "uint16", block: int = BLOCK) -> DataFrame:
    """(file, ordinal, n_tokens) of every document of the flat files under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    blocks = files.select("path", "content").mapInArrow(_scan(end, dtype, block), _SUMMARY)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = blocks.withColumns({"open": F.coalesce(F.sum("tail").over(before), F.lit(0)), "first": F.coalesce(F.sum("n_separators").over(before), F.lit(0))})
    # tokens left open by the blocks since the last one with a separator; that block's own head does not count
    mark = F.when(F.col("n_separators") > 0, F.col("open"))
    carried = so_far.withColumn("carry", F.col("open") - F.coalesce(F.max(mark).over(before), F.lit(0)))
    counts = F.concat(F.array(F.col("carry") + F.col("head")), "inner")
    closed = carried.where("n_separators > 0").select("file", "first", F.posexplode(counts).alias("i", "n_tokens")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")
    rest = carried.groupBy("file").agg(F.sum("n_separators").alias("ordinal"), (F.sum("tail") - F.coalesce(F.max(mark), F.lit(0))).alias("n_tokens"))
    return closed.unionByName(rest.where("n_tokens > 0"))


def document_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TF.TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens): tokenise into flat files and count there."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens/{uuid.uuid4().hex}"
    placed = _placed(docs, id_col, text_col)
    write_token_files(placed, path, tokenizer)
    source, first = (F.regexp_extract("file", f"/{c}=(-?[0-9]+)/", 1).cast("long") for c in ("source", "first"))
    counts = token_counts(spark, path).select(source.alias("source"), (first + F.col("ordinal")).alias("row"), "n_tokens")
    rows = placed.select("doc_id", "source", "row", F.lit(1).alias("held"))
    out, seen = cut_lineage_observed(
        rows.join(counts, ["source", "row"], "full").select("doc_id", "n_tokens", "held"),
        rows=F.count("held"), counted=F.count("n_tokens"), both=F.count_if(F.col("held").isNotNull() & F.col("n_tokens").isNotNull()),
    )
    if not seen["rows"] == seen["counted"] == seen["both"]:
        raise RuntimeError(f"{seen['rows']} documents and {seen['counted']} counts, {seen['both']} in the same place")
    return out.select("doc_id", "n_tokens")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over every whole text of ``documents``."""
    return document_token_counts(documents(spark, sf_dir))
