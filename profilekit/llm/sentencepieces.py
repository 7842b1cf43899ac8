"""Operator 7: SentencePiece models run by the tokenizers library.

The model's protobuf is parsed field by field; from it are rebuilt the
normaliser (its compiled character map, if any, and white-space removal), the
metaspace marker, the piece scores (a unigram model as it is; a BPE model's
merges ranked by the scores of the pieces they make) and the byte fallback.
No piece of such a model has the marker behind another character, so a text's
ids are the ids of its marker-led segments in order; segments are memoised and
the unknown ones of a batch are encoded in one multithreaded call: those ids are
the result. Every new segment is also encoded by the sentencepiece library: if
the two differ, the document's ``parity`` is false.

Cases: null and empty text have no ids and decode to the empty text. Very long
texts are encoded whole. Repeated rows give repeated results; an empty table
gives no rows; only the kept columns are returned.
"""

from __future__ import annotations

import os
import struct
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from profilekit.llm.text import crc32, map_texts, worker_cache

DEFAULT_MODEL = "piece_bpe_32k.model"
THREADS = 2  # per worker; more only add memory where tasks already use every core
BATCH = 4_000  # segments encoded in one call
SEGMENT_ENTRIES = 200_000  # memoised segments; bounds memory, never results
GROUP_CHARS = 500_000  # text cut into segments at once; bounds memory, never results
MARKER = "▁"
# piece types and model types of the format: fixed values
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, i
        shift += 7


def proto_fields(data: bytes):
    """(field number, value) of a protobuf message; values stay raw but for numbers."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        elif kind == 2:
            n, i = _varint(data, i)
            value, i = data[i:i + n], i + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = struct.unpack("<d" if kind == 1 else "<f", data[i:i + n])[0], i + n
        else:
            raise ValueError(f"not a SentencePiece model: wire type {kind}")
        yield key >> 3, value


class Model:
    """What a model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normaliser: dict = {}
        for field, value in proto_fields(data):
            if field == 1:
                piece = dict(proto_fields(value))
                self.pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(proto_fields(value))
            elif field == 3:
                normaliser = dict(proto_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unk_id = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.char_map: bytes = normaliser.get(2, b"")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.squeeze_spaces = bool(normaliser.get(4, 1))
        if not normaliser.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models with a leading white-space marker are handled")

    def merges(self) -> list[tuple[str, str]]:
        """Splits of each piece into two pieces, best made piece first."""
        usable = {p: s for p, s, kind in self.pieces if kind in (NORMAL, USER_DEFINED)}
        place = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        found = [(-score, place[p[:k]], place[p[k:]], p[:k], p[k:]) for p, score in usable.items()
                 for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        return [(a, b) for *_, a, b in sorted(found)]


class Pieces:
    """Encoder and decoder of one model."""

    def __init__(self, data: bytes):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "true"  # the batches of this encoder use several threads
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        from tokenizers import Tokenizer, models, normalizers

        self.model = m = Model(data)
        if m.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
            core = models.BPE(vocab, m.merges(), unk_token=m.pieces[m.unk_id][0], fuse_unk=True,
                              byte_fallback=m.byte_fallback)
        elif m.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk_id, m.byte_fallback)
        else:
            raise ValueError(f"model type {m.kind} is not handled")
        self.backend = Tokenizer(core)
        self.normaliser = normalizers.Precompiled(m.char_map) if m.char_map else None
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        inner = regex.compile(f"[^{MARKER}]{MARKER}")
        self.by_segment = not any(inner.search(p) for p, _, _ in m.pieces) and m.kind == BPE
        self._known: dict[str, bytes] = {}
        self._apart: set[str] = set()  # memoised segments the libraries do not agree on
        raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else
               b"" if kind == CONTROL else b" \xe2\x81\x87 " if kind == UNKNOWN else
               p.replace(MARKER, " ").encode() for p, _, kind in m.pieces]
        self._sizes = np.asarray([len(x) for x in raw], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._blob = np.frombuffer(b"".join(raw), np.uint8)

    def prepared(self, text: str) -> str:
        """The text after normaliser, white-space handling and dummy prefix (a literal marker is a space)."""
        if self.normaliser:
            text = self.normaliser.normalize_str(text)
        if self.model.squeeze_spaces:
            text = regex.sub(" {2,}", " ", text).strip(" ")
        if not text:
            return ""
        return (" " if self.model.dummy_prefix else "") + text.replace(MARKER, " ")

    def _segments(self, prepared: str) -> list[str]:
        """Marker-led runs: a space starts a new one unless it follows a space."""
        if not self.by_segment:
            return [prepared] if prepared else []
        if "  " not in prepared:
            first, *rest = prepared.split(" ")
            return ([first] if first else []) + [" " + w for w in rest]
        return regex.findall(r" *[^ ]+| +", prepared)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether both libraries agreed on all of its segments."""
        return self.encode_prepared([self.prepared(t) for t in texts])

    def encode_prepared(self, prepared: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """``encode`` of texts that ``prepared`` has made, some at a time (each whole)."""
        ids, same, at = [], [], 0
        while at < len(prepared):
            stop, size = at + 1, len(prepared[at])
            while stop < len(prepared) and size + len(prepared[stop]) <= GROUP_CHARS:
                size += len(prepared[stop])
                stop += 1
            cut = [self._segments(t) for t in prepared[at:stop]]
            at = stop
            if len(self._known) > SEGMENT_ENTRIES:
                self._known.clear()
                self._apart.clear()
            new = list(set().union(*cut).difference(self._known))
            for k in range(0, len(new), BATCH):  # encodings are bulky: few at once
                self._learn(new[k:k + BATCH])
            for segments in cut:
                ids.append(np.frombuffer(b"".join(map(self._known.__getitem__, segments)), "<u4"))
                same.append(self._apart.isdisjoint(segments) if self._apart else True)
        return ids, same

    def _learn(self, segments: list[str]) -> None:
        """Memoise the ids of segments, and whether both libraries agree on them."""
        made = self.backend.encode_batch_fast([s.replace(" ", MARKER) for s in segments], add_special_tokens=False)
        # the library adds the marker itself where the model asks for it
        lead = 1 if self.model.dummy_prefix else 0
        led = [s[lead:] if s.startswith(" ") else s for s in segments]
        wanted = self.library.encode(led, num_threads=1)
        for s, x, got, want in zip(segments, led, made, wanted, strict=True):
            # the backend answers; the library only tells whether it agrees (of a lone space it has no opinion)
            self._known[s] = array("I", got.ids).tobytes()
            if got.ids != want and (x or not s):
                self._apart.add(s)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids: pieces joined, byte pieces as bytes, the dummy prefix removed."""
        if not len(ids):
            return b""
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self._starts[ids] - (ends - sizes), sizes)
        out = self._blob[at].tobytes()
        return out[1:] if self.model.dummy_prefix and out.startswith(b" ") else out


_PIECES: dict[bytes, Pieces] = worker_cache({})


def pieces(data: bytes) -> Pieces:
    """One encoder per worker and model file."""
    if data not in _PIECES:
        _PIECES.clear()
        _PIECES[data] = Pieces(data)
    return _PIECES[data]


def encode_pieces(docs: DataFrame, model: str | None = None, *, text: str = "text", keep=("doc_id",),
                  with_ids: bool = True) -> DataFrame:
    """``keep`` columns, n_tokens, ids_crc32, parity, round_trip and (if ``with_ids``) ids of each text.

    ``round_trip``: the ids decode to the (normalised) text.
    """
    with open(model or public_tokenizers.path(DEFAULT_MODEL), "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one model file, under a few MB
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def make():
        p = pieces(spec.value)
        strip = 1 if p.model.dummy_prefix else 0

        def run(texts):
            plain = [t.decode() if t else "" for t in texts]
            prepared = [p.prepared(t) for t in plain]
            ids, same = p.encode_prepared(prepared)
            back = [p.decode(x) == t.encode()[strip:] for x, t in zip(ids, prepared, strict=True)]
            out = [[len(x) for x in ids], [crc32(x.tobytes()) for x in ids], same, back]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
            return out
        return run

    return map_texts(docs, make, fields, text=text, keep=keep)
