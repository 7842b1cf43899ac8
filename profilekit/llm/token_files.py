"""Operator 6: token ids as flat unsigned-integer files with 64-bit document offsets.

Format. Documents are range-partitioned and sorted by id; each partition
writes one shard of three flat little-endian files: ``.ids`` (uint16 if the
vocabulary fits, else uint32), ``.offsets`` (uint64, one more than documents,
counted in ids from the shard's start) and ``.docs`` (int64 document ids). A
manifest row per shard holds the file names and counts; the shards' global
bases are prefix sums of the counts. Files get names of their own per task
attempt and count only once the manifest, written by Spark, lists them: a
retried or lost task leaves at worst unlisted files. Files live in the shared
checkpoint folder and are opened through its file system; local ones are
memory-mapped on reading.

Cases: null and empty text hold the end id only. Documents of equal id are
ordered by text (null first) and all kept; a null id sorts first and is read
back as null. Very long texts are encoded whole. An empty table gives an empty
manifest and no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profilekit.llm.text import CACHE_ENTRIES, claim, col, crc32, slices, worker_cache
from profilekit.session import shared_path

DEFAULT_TOKENIZER = "word_bpe_49k.json"
NULL_ID = -(1 << 63)  # stands for a null document id in the .docs file
_MANIFEST = "ids string, offsets string, docs string, first long, n_docs long, n_ids long, width int"
# the splits below are exact only for files whose white space never reaches a token
_STOPS = (b".", b",")
_LATIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a plain local path."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class WordEncoder:
    """Ids of a text as the bytes of a flat integer array, from memoised ids of its words.

    Valid for tokenizer files that drop white space before the merges, so that
    a text's ids are its words' ids in order. Unknown words of a batch are
    encoded by the library in one call.
    """

    def __init__(self, tokenizer_json: bytes):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        for probe in ("a b", "a  b", " a\nb ", "ab, c."):
            if self.tokenizer.encode(probe, add_special_tokens=False).ids != [
                    i for w in re.findall(r"\w+|[,.]", probe) for i in self.tokenizer.encode(w, add_special_tokens=False).ids]:
                raise ValueError("this tokenizer file keeps white space; it can't be encoded word by word")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # lower-case Latin letters pass the normaliser and the splits unchanged: only the merges are left
        self.letters = Tokenizer.from_str(tokenizer_json.decode())
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        probe = ["hello", "straße", "déjà", "ñandú", "ÿ"]
        if [e.ids for e in self.letters.encode_batch(probe)] != [e.ids for e in self.tokenizer.encode_batch(probe)]:
            self.letters = self.tokenizer
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        # A-Z fall to lower case in the tokenizer anyway; doing it first leaves fewer distinct words
        words = [(t if b"<|" in t else t.lower()).replace(b"\n", b" ").split(b" ") if t else [] for t in texts]
        known = self._known
        if len(known) > 3 * CACHE_ENTRIES:
            known.clear()
        new = set().union(*words).difference(known)
        # punctuation behind a letter is split off before the merges
        ended = {w: w[:-1] for w in new if w[-1:] in _STOPS and w[-2:-1].isalnum()}
        plain = ((new - ended.keys()) | set(ended.values()) | {w[-1:] for w in ended}).difference(known)
        simple, other = [], []
        for w in plain:
            x = w.decode()
            (simple if _LATIN(x) else other).append((w, x))
        for tokenizer, group in ((self.letters, simple), (self.tokenizer, other)):
            made = tokenizer.encode_batch_fast([x for _, x in group], add_special_tokens=False)
            for (w, _), e in zip(group, made, strict=True):
                known[w] = array(self._code, e.ids).tobytes()
        for w, core in ended.items():
            known[w] = known[core] + known[w[-1:]]
        get = known.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


_ENCODERS: dict[bytes, WordEncoder] = worker_cache({})


def encoder(tokenizer_json: bytes) -> WordEncoder:
    """One encoder per worker and tokenizer file."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer_json] = WordEncoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                      end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards and return their manifest (with ``base``, the ids before each shard)."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files")
    files = folder.rstrip("/") + "/shards"
    with open(tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER), "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one tokenizer file, a few MB
    src = (docs.select(col(doc_id).cast("long").alias("d"), col(text).cast("string").cast("binary").alias("t"))
           .repartitionByRange("d").sortWithinPartitions("d", "t"))

    def write(batches):
        claim(__name__)
        enc = encoder(spec.value)
        end = np.asarray([end_id], enc.dtype).tobytes()
        target, path = open_uri(files)
        target.create_dir(path, recursive=True)
        name, ids_out = f"{path}/{uuid.uuid4().hex}", None
        ends, doc_ids, n = [np.zeros(1, np.uint64)], [], 0
        for b in slices(batches, 1):
            if ids_out is None:
                ids_out = target.open_output_stream(name + ".ids")
            made = enc.encode(b.column(1).to_pylist())
            for x in made:
                ids_out.write(x)
                ids_out.write(end)
            sizes = np.asarray([len(x) for x in made], np.uint64) // enc.dtype.itemsize + 1
            ends.append(n + np.cumsum(sizes, dtype=np.uint64))
            n = int(ends[-1][-1])
            doc_ids.append(b.column(0).fill_null(NULL_ID).to_numpy().astype("<i8"))
        if ids_out is None:
            return
        ids_out.close()
        offsets, owners = np.concatenate(ends).astype("<u8"), np.concatenate(doc_ids)
        for suffix, values in ((".offsets", offsets), (".docs", owners)):
            with target.open_output_stream(name + suffix) as out:
                out.write(values.tobytes())
        base = files + name[len(path):]
        row = [base + ".ids", base + ".offsets", base + ".docs", int(owners[0]), len(owners), n, enc.dtype.itemsize]
        names = [c.split()[0] for c in _MANIFEST.split(", ")]
        types = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    src.mapInArrow(write, _MANIFEST).write.parquet(folder.rstrip("/") + "/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder in document order, with ``base``: the ids of all shards before (a prefix sum)."""
    rows = spark.read.parquet(folder.rstrip("/") + "/manifest")
    # one row per shard; ranges of ids do not overlap
    before = Window.orderBy("first", "offsets").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _flat(uri: str, dtype: np.dtype):
    target, path = open_uri(uri)
    if isinstance(target, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with target.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 (over 32-bit ids) and, if asked, ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    src = manifest.select("ids", "offsets", "docs", "base", "width")

    def read(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = _flat(r["ids"], np.dtype(f"<u{r['width']}"))
                offsets, owners = _flat(r["offsets"], np.dtype("<u8")).astype(np.int64), _flat(r["docs"], np.dtype("<i8"))
                for at in range(0, len(owners), 5000):
                    span = list(zip(offsets[at:at + 5000], offsets[at + 1:at + 5001], strict=False))
                    cols = [pa.array(owners[at:at + 5000], mask=owners[at:at + 5000] == NULL_ID),
                            pa.array(offsets[at:at + len(span)] + r["base"]),
                            pa.array([int(e - s) for s, e in span], pa.int64()),
                            pa.array([crc32(ids[s:e].astype("<u4").tobytes()) for s, e in span], pa.int64())]
                    if with_ids:
                        cols.append(pa.array([ids[s:e].astype(np.int64) for s, e in span], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    # as many tasks as shards (a given number is not coalesced, however small the manifest's rows are)
    shards = manifest.count()
    return src.repartitionByRange(max(1, shards), "ids").mapInArrow(read, schema)
