"""Operator 12: SentencePiece encoding and decoding that keeps source offsets.

A text is normalised by the longest prefixes that the model's compiled character map knows (a
double-array trie; characters it does not know stay), and every normalised character records the
source byte at which its prefix starts. Byte-pair merging then runs on characters; each piece's
span in the normalised text is projected to source bytes through that record.

Merging is done segment by segment. A segment ends where no piece of the vocabulary can go on:
before a blank mark that follows another character (checked on the vocabulary), and around
characters that occur in no piece of more than one character. Segments are encoded once and
remembered per worker process, within a bound.

Model features this library's models use are supported: BPE, byte fallback, dummy prefix, removal
of extra blanks. User-defined symbols, suffix blanks and other model types raise ``ValueError``.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.bpe import Merges, in_order
from faultline.llm.memory import WordMemory, of_process

# Fixed values of the model format: the blank mark, kinds of pieces, the model type.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
GROUP_BYTES = 1 << 21
SHORT = 64
SCHEMA = "ids array<int>, begins array<int>, ends array<int>, decoded string"


def characters(raw: bytes) -> tuple[str, np.ndarray]:
    """The characters of a UTF-8 text and the byte at which each starts, and the end.

    Every byte that is not part of a valid character counts as U+FFFD.
    """
    codes = np.frombuffer(raw, np.uint8)
    starts, bad = (codes & 0xC0) != 0x80, []
    try:
        text = raw.decode()
    except UnicodeDecodeError:

        def one_byte(error):
            bad.append(error.start)
            return "�", error.start + 1

        codecs.register_error("one_byte", one_byte)
        text = raw.decode("utf-8", "one_byte")
        starts[bad] = True
    return text, np.r_[np.flatnonzero(starts), len(raw)]


class CharacterMap:
    """A compiled character map: the size of a double-array trie, the trie, the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, str] | None:
        """The end of the longest known prefix of ``raw[at:]`` and its replacement."""
        units, found = self.units, None
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for end in range(at, len(raw)):
            node ^= raw[end]
            if node >= len(units) or units[node] & 0x800000FF != raw[end]:
                break
            unit = units[node]
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = end + 1, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        stop = self.texts.index(b"\0", found[1])
        return found[0], self.texts[found[1] : stop].decode()


class Normalizer:
    """Normalised text and, per character of it and for its end, the source byte."""

    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, remove_extra: bool = False):
        self.map = CharacterMap(charsmap) if charsmap else None
        self.dummy_prefix, self.remove_extra = dummy_prefix, remove_extra

    def __call__(self, raw: bytes) -> tuple[str, np.ndarray]:
        text, starts = characters(raw)
        if self.map:
            text, starts = self._mapped(raw, text, starts)
        if self.remove_extra:
            text, starts = self._single_blanks(text, starts)
        if not text:
            return "", starts[-1:]
        if self.dummy_prefix:
            text, starts = " " + text, np.r_[starts[:1], starts]
        text = text.replace(" ", MARK)
        if self.remove_extra:
            # Marks at the end go, be they blanks or marks of the source, and the end is where they began.
            text = text.rstrip(MARK)
            starts = starts[: len(text) + 1]
        return text, starts

    def _mapped(self, raw: bytes, text: str, starts: np.ndarray) -> tuple[str, np.ndarray]:
        out, sources, i, begins = [], [], 0, starts.tolist()
        while i < len(text):
            known = self.map.longest(raw, begins[i])
            new, end = (text[i], begins[i + 1]) if known is None else (known[1], known[0])
            out.append(new)
            sources += [begins[i]] * len(new)
            i = int(np.searchsorted(starts, end)) if end != begins[i + 1] else i + 1
        return "".join(out), np.array([*sources, len(raw)], np.int64)

    @staticmethod
    def _single_blanks(text: str, starts: np.ndarray) -> tuple[str, np.ndarray]:
        blank = np.array([c == " " for c in text], bool)
        at = np.flatnonzero(~(blank & np.r_[True, blank[:-1]])) if text else []
        if not len(at):
            return "", starts[:1]
        return "".join([text[i] for i in at.tolist()]), np.r_[starts[at], starts[-1]]


class PieceModel:
    """Pieces, merges and decoding of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE_MODEL or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        if model.trainer_spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("only models that mark blanks before words are supported")
        spec = model.normalizer_spec
        self.normalize = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        self.dummy_prefix, self.remove_extra = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [byte[b] for b in range(256)] if len(byte) == 256 else None
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        of_byte = {i: b for b, i in byte.items()}
        self.surfaces = [
            b"" if p.type == CONTROL else model.trainer_spec.unk_surface.encode() if p.type == UNKNOWN
            else bytes([of_byte[i]]) if i in of_byte else p.piece.replace(MARK, " ").encode()
            for i, p in enumerate(model.pieces)
        ]
        self.marked = {i for i, p in enumerate(model.pieces) if p.type == NORMAL and p.piece.startswith(MARK)}
        self.controls = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.segments = self._segments()
        self._number_pairs()
        self.memory = WordMemory(self._encode_segments, 2, batch=GROUP_BYTES)

    def _segments(self) -> re.Pattern:
        long = [p for p in self.ids if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            return re.compile(r"(?s).+")
        joined = sorted({c for p in long for c in p} - {MARK})
        body = "".join(map(re.escape, joined))
        return re.compile(f"{MARK}*[{body}]+|{MARK}+|[^{MARK}]" if body else f"{MARK}+|[^{MARK}]")

    def _number_pairs(self) -> None:
        """Numbers for symbols (ids of pieces, then other characters that pieces have), and every pair
        of symbols that makes a piece, ranked by the piece's score."""
        symbols = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p}):
            symbols.setdefault(c, len(self.surfaces) + len(symbols))
        rank = {x: i for i, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.merges = Merges(
            [
                (symbols[p[:i]], symbols[p[i:]], rank[self.scores[p]], made)
                for p, made in self.ids.items()
                for i in range(1, len(p))
                if p[:i] in symbols and p[i:] in symbols
            ],
            max(symbols.values()) + 1,
        )
        self.of_code = np.full(0x110000, -1, np.int64)
        self.piece_chars = np.zeros(len(self.surfaces), np.int32)
        for p, i in self.ids.items():
            self.piece_chars[i] = len(p)
            if len(p) == 1:
                self.of_code[ord(p)] = i

    def merge(self, text: str) -> list[str]:
        """Pieces of a segment: the best-scored adjacent pair that is a piece is merged, the
        leftmost of equals, until there is none."""
        if len(text) > SHORT:
            return self._merge_long(text)
        score, none = self.scores.get, float("-inf")
        parts = list(text)
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        """The same with a heap of pairs, for long segments."""
        n, score = len(text), self.scores.get
        parts: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(i: int, j: int) -> None:
            made = parts[i] + parts[j]
            if (s := score(made)) is not None:
                heapq.heappush(heap, (-s, i, len(made)))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, length = heapq.heappop(heap)
            j = after[i]
            # Stale: a part has gone or grown since the pair was offered.
            if parts[i] is None or j == n or len(parts[i]) + len(parts[j]) != length:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def _encode_segments(self, segments: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids and lengths in characters. Of the bytes of an unknown character the last has its length."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols, starts = self.of_code[codes], np.cumsum(size) - size
        known = np.minimum.reduceat(symbols, starts) >= 0 if len(segments) else np.zeros(0, bool)
        plain = known & (size <= SHORT)
        at = np.flatnonzero(plain)
        found = [(at[rows], ids, self.piece_chars[ids]) for rows, ids in self.merges.merge(symbols[np.repeat(plain, size)], size[at])]
        for i in np.flatnonzero(~plain).tolist():
            ids, lengths = self._encode_segment(segments[i])
            found.append((np.array([i]), ids[None], lengths[None]))
        return in_order(found, len(segments))

    def _encode_segment(self, segment: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for one segment, with long segments and unknown characters."""
        ids, lengths = [], []
        for piece in self.merge(segment):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
                lengths.append(len(piece))
            elif self.bytes:
                raw = piece.encode("utf-8", "surrogatepass")
                ids += [self.bytes[b] for b in raw]
                lengths += [0] * (len(raw) - 1) + [len(piece)]
            else:
                ids.append(self.unknown)
                lengths.append(len(piece))
        return np.array(ids, np.int32), np.array(lengths, np.int32)

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids, and where each piece begins and ends in the source, in bytes."""
        normal = [self.normalize(t) for t in texts]
        out = []
        for (ids, lengths), (_, starts) in zip(self.memory([self.segments.findall(t) for t, _ in normal]), normal):
            edges = starts[np.r_[0, np.cumsum(lengths)]].astype(np.int32)
            out.append((ids, edges[:-1], edges[1:]))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: surfaces in a row, without the dummy prefix."""
        first = next((i for i, x in enumerate(ids) if x not in self.controls), None)
        raw = b"".join(map(self.surfaces.__getitem__, ids))
        if first is not None and ids[first] in self.marked:
            raw = raw.lstrip(b" ") if self.remove_extra else raw[1:] if self.dummy_prefix else raw
        return characters(raw)[0]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, begins, ends, decoded`` per row of ``docs``.

    ``ids`` are those of the model without begin or end ids; piece i covers source bytes
    ``begins[i]`` to ``ends[i]`` (exclusive) of the text in UTF-8 (the dummy prefix covers none, and
    of an unknown character's byte pieces only the last covers it); ``decoded`` is the text the ids
    stand for. Whole texts are encoded; a null text counts as empty and has no ids; null ids and
    repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        edges = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(arrays).astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = of_process(f"pieces {model_path}", partial(PieceModel, model_path))

        def encoded(doc_ids: list, texts: list[bytes]) -> pa.RecordBatch:
            ids, begins, ends = zip(*model.encode(texts))
            decoded = pa.array([model.decode(x.tolist()) for x in ids], pa.string())
            columns = [pa.array(doc_ids, pa.int64()), lists(ids), lists(begins), lists(ends), decoded]
            return pa.record_batch(columns, ["doc_id", "ids", "begins", "ends", "decoded"])

        for batch in batches:
            doc_ids, texts, size = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_ids.append(doc_id.as_py())
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= GROUP_BYTES:
                    yield encoded(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
            if doc_ids:
                yield encoded(doc_ids, texts)

    return rows.mapInArrow(run, f"doc_id bigint, {SCHEMA}")
