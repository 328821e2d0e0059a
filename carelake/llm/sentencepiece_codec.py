"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model's protobuf is parsed and rebuilt as a ``tokenizers`` model: the
normaliser (dummy prefix, white space to the metaspace marker, precompiled
character map if there is one), the unigram scores or, for a BPE model, the
merges in the order of its piece scores, and byte fallback. Batches are
encoded on several threads.

White-space runs need care: their pieces all have one score, for which
SentencePiece merges leftmost first, and ``tokenizers`` can't. They are left
single by the rebuilt model and merged afterwards by that rule.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Characters handed to the library at once, and threads that encode them.
SLICE, THREADS = 1 << 18, 2


def parse_model(model: bytes):
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


class Codec:
    """encode(texts) -> lists of ids; decode(lists of ids) -> texts."""

    def __init__(self, model: bytes):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers
        proto = parse_model(model)
        spec, pieces = proto.normalizer_spec, list(proto.pieces)
        self.unigram = proto.trainer_spec.model_type == proto.trainer_spec.UNIGRAM
        if not self.unigram and proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError("only unigram and BPE models can be rebuilt")
        self.pieces = [p.piece for p in pieces]
        self.id_of = {p: i for i, p in enumerate(self.pieces)}
        self.unk = next(i for i, p in enumerate(pieces) if p.type == p.UNKNOWN)
        self.bytes = {i: int(p.piece[3:5], 16) for i, p in enumerate(pieces) if p.type == p.BYTE}
        self.silent = {i for i, p in enumerate(pieces) if p.type == p.CONTROL}
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        usable = {p.piece: (p.score, i) for i, p in enumerate(pieces) if p.type in (p.NORMAL, p.USER_DEFINED)}
        if self.unigram:
            # control symbols and byte pieces can't be met in a text
            low = min((p.score for p in pieces if p.type == p.NORMAL), default=0.0)
            vocabulary = [(p.piece, p.score if p.type in (p.NORMAL, p.USER_DEFINED) else low - 100.0) for p in pieces]
            core = models.Unigram(vocabulary, self.unk, proto.trainer_spec.byte_fallback)
            self.runs: dict[int, list[int]] | None = None
        else:
            merges = []
            for piece, (score, _) in usable.items():
                if set(piece) == {MARK}:
                    continue
                merges += [(-score, piece[:cut], piece[cut:]) for cut in range(1, len(piece))
                           if piece[:cut] in usable and piece[cut:] in usable]
            merges.sort(key=lambda m: (m[0], len(m[1])))
            core = models.BPE({p: i for i, p in enumerate(self.pieces)}, [(a, b) for _, a, b in merges],
                              unk_token=self.pieces[self.unk], byte_fallback=proto.trainer_spec.byte_fallback, fuse_unk=True)
            self.runs = {}
        self.mark = self.id_of.get(MARK)
        steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        steps.append(normalizers.Replace(" ", MARK))
        self.inner, self.first = Tokenizer(core), Tokenizer(core)
        self.inner.normalizer = normalizers.Sequence(steps)
        self.first.normalizer = normalizers.Sequence(steps + ([normalizers.Prepend(MARK)] if self.prefix else []))
        # no piece has the marker behind another character, so words are independent
        self.by_word = not any(MARK in p.lstrip(MARK) for p in usable)
        if self.by_word:
            for t in (self.inner, self.first):
                t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")

    def _run(self, n: int) -> list[int]:
        """The pieces of n markers in a row: equal scores, leftmost first."""
        if n not in self.runs:
            parts = [1] * n
            while True:
                at = next((i for i in range(len(parts) - 1) if MARK * (parts[i] + parts[i + 1]) in self.id_of), None)
                if at is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.runs[n] = [self.id_of[MARK * k] for k in parts]
        return self.runs[n]

    def _merge_runs(self, ids: list[int]) -> list[int]:
        mark, out, at, n = self.mark, [], 0, len(ids)
        while at < n:
            if ids[at] != mark:
                out.append(ids[at])
                at += 1
                continue
            to = at
            while to < n and ids[to] == mark:
                to += 1
            out += self._run(to - at)
            at = to
        return out

    def _parts(self, text: str) -> list[str]:
        """Cut a very long text before single spaces, where words end anyway."""
        if len(text) <= SLICE or not self.by_word or self.squeeze:
            return [text]
        parts, at = [], 0
        while len(text) - at > SLICE:
            to = text.find(" ", at + SLICE)
            while to > 0 and (text[to - 1] in " " + MARK or text[to + 1:to + 2] in (" ", MARK, "")):
                to = text.find(" ", to + 1)
            if to < 0:
                break
            parts.append(text[at:to])
            at = to
        return [*parts, text[at:]]

    def encode(self, texts: list[str]) -> list[list[int]]:
        heads, tails, owner = [], [], []
        for i, text in enumerate(texts):
            head, *more = self._parts(text)
            heads.append(head)
            tails += more
            owner += [i] * len(more)
        out = [e.ids for e in self.first.encode_batch_fast(heads, add_special_tokens=False)]
        for i, e in zip(owner, self.inner.encode_batch_fast(tails, add_special_tokens=False) if tails else [], strict=True):
            out[i] = out[i] + e.ids
        if self.runs is not None and self.mark is not None:
            both = f"{MARK}{MARK}"
            out = [self._merge_runs(ids) if "  " in t or t[:1] in (" ", MARK) or both in t or f" {MARK}" in t or f"{MARK} " in t
                   else ids for t, ids in zip(texts, out, strict=True)]
        return out

    def decode(self, rows: list[list[int]]) -> list[str]:
        pieces, raw, silent = self.pieces, self.bytes, self.silent
        out = []
        for ids in rows:
            if not raw.keys().isdisjoint(ids):
                parts, pending = [], bytearray()
                for i in ids:
                    if i in raw:
                        pending.append(raw[i])
                        continue
                    if pending:
                        parts.append(pending.decode("utf-8", "replace"))
                        pending = bytearray()
                    parts.append(" ⁇ " if i == self.unk else "" if i in silent else pieces[i])
                if pending:
                    parts.append(pending.decode("utf-8", "replace"))
            else:
                parts = [" ⁇ " if i == self.unk else "" if i in silent else pieces[i] for i in ids]
            text = "".join(parts).replace(MARK, " ")
            out.append(text[1:] if self.prefix and text[:1] == " " else text)
        return out


_codecs: dict[int, Codec] = {}


def _codec(model: bytes) -> Codec:
    key = zlib.crc32(model)
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def _slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > SLICE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part


def _encode_rows(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            at = 0
            for texts in _slices([t.as_py() for t in batch.column(1)]):
                ids = codec.encode([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.array([None if t is None else x for t, x in zip(texts, ids, strict=True)], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])
                at += len(texts)
    return run


def _decode_rows(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = part.column(1).to_pylist()
                texts = codec.decode([r or [] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([None if r is None else t for r, t in zip(rows, texts, strict=True)], pa.string())],
                    names=["doc_id", "text"])
    return run


def _digest_rows(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            at = 0
            for texts in _slices([t.as_py() for t in batch.column(1)]):
                ids = codec.encode([t or "" for t in texts])
                back = codec.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(pa.array(x, pa.int32()).buffers()[1] or b"") if x else 0 for x in ids], pa.int64()),
                     pa.array([None if t is None else b == t for t, b in zip(texts, back, strict=True)], pa.bool_())],
                    names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])
                at += len(texts)
    return run


def _ids_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>), one row per row of ``docs``; null for a null
    text, empty for an empty one. Other columns are not read."""
    return _two(docs, id_col, text_col).mapInArrow(
        _encode_rows(model), f"doc_id {_ids_type(docs, id_col)}, ids array<int>")


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the inverse of ``encode``, null for null ids."""
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        _decode_rows(model), f"doc_id {_ids_type(encoded, id_col)}, text string")


def encoding_digest(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip): each whole text encoded,
    decoded again and compared. ids_crc32 is over the ids as little-endian
    32-bit integers, 0 if there are none; round_trip is null for a null text
    and false where the model can't express the text (the marker itself)."""
    return _two(docs, id_col, text_col).mapInArrow(
        _digest_rows(model), f"doc_id {_ids_type(docs, id_col)}, n_tokens long, ids_crc32 long, round_trip boolean")
