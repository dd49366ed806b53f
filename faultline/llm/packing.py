"""Operator 9: best-fit packing of token sequences by patterns of lengths.

Documents are tokenized, closed with an end id and cut at ``SEQUENCE`` tokens. How to pack depends
only on how many pieces there are of each length, at most ``SEQUENCE`` numbers:

1. every pattern of one to three lengths that fills a sequence exactly, with lengths that occur,
   is enumerated; non-negative least squares fits how often to use each so that together they
   use up the histogram; the counts are rounded down and never use more pieces than there are;
2. what is left is packed best-fit, longest first, on the histogram: equal pieces into equally
   filled sequences at once.

The plan lists, per length, runs of consecutive pieces and where they go. Each piece then finds
its place by its number among the pieces of its length. Numbers are dealt by (length, bucket),
so a length that a third of all pieces share is numbered by many tasks.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.bpe import Merges, in_order
from faultline.llm.common import cut, partitions
from faultline.llm.memory import ENCODE_WORDS, WordMemory, of_process

SEQUENCE = 2048
END_ID = 0
# Fixed value: a special token of the tokenizer.
BETWEEN = "<|startoftext|>"
# Texts that show whether a tokenizer joins across blanks.
PROBES = ("one two  three", "a b c", "don't 12 34 !! ?", "New York\nnew\tyork", "über naïve 中文 中")
GROUP_CHARS = 1 << 21
# In UTF-8: bytes of plain words (printable ASCII without the apostrophe, which some splits treat as part
# of a word; the second bytes of Latin-1 letters), how plain words are lower-cased, and their parts.
_ASCII = np.array([33 <= b <= 126 and b != 39 for b in range(256)])
_LATIN = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
_PARTS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+|[0-9]| |[^a-z0-9\x80-\xff ]+")
# Fixed value: the steps before merging under which these parts are right.
PLAIN_STEPS = [
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True,
         "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
]
# Rows that a task numbers, about; salts that spread rows alike; rows up to which a side is broadcast.
BUCKET_ROWS = 200_000
SALTS = 1024
SMALL_ROWS = 200_000
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _blocks(words: np.ndarray, ids: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids in a row, ``n`` for each word, as blocks of words with equally many."""
    start = np.cumsum(n) - n
    return [(words[rows], ids[start[rows][:, None] + np.arange(k)]) for k in np.unique(n).tolist() for rows in [np.flatnonzero(n == k)]]


class WordTokenizer:
    """Ids of whole texts from ids of words, for a tokenizer that never joins across blanks.

    Splitting is at ASCII blanks only; anything else is left to the tokenizer. Another kind of
    tokenizer is refused: one whose ids for blank-separated probes are not those of the words.
    Words are remembered within a bound (``WordMemory``).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        for probe in PROBES:
            parts = [i for w in probe.split() for i in self._ids(w)]
            if self._ids(probe) != parts:
                raise ValueError("this tokenizer does not treat blank-separated words one by one")
        self.merges = self._plain_merges()
        self.memory = WordMemory(self._encode, 1, batch=GROUP_CHARS)

    def _plain_merges(self) -> Merges | None:
        """Merges for plain words (``_plain``), if the tokenizer does nothing but lower their case, split them
        into letters, single digits and the rest, and merge bytes of which the last carries the mark of
        a word's end. (A byte that is no printable character of Latin-1 is named by one beyond it.)"""
        model = json.loads(self.tokenizer.to_str())
        bpe = model["model"]
        wanted = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "ignore_merges": False}
        steps = [model.get("normalizer"), model.get("pre_tokenizer")]
        if any(bpe.get(k) != v for k, v in wanted.items()) or not bpe.get("end_of_word_suffix") or steps != PLAIN_STEPS:
            return None
        vocab, end = bpe["vocab"], bpe["end_of_word_suffix"]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.inside, self.last = (np.array([vocab.get(names[b] + e, -1) for b in range(256)], np.int64) for e in ("", end))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in bpe["merges"]]
        return Merges([(vocab[a], vocab[b], i, vocab[a + b]) for i, (a, b) in enumerate(pairs)], len(vocab))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of all words in a row and how many each has."""
        plain = self._plain(words) if self.merges else np.zeros(len(words), bool)
        at = np.flatnonzero(plain)
        found = self._merge_plain([words[i] for i in at.tolist()], at) if len(at) else []
        other = np.flatnonzero(~plain).tolist()
        for s in range(0, len(other), ENCODE_WORDS):
            part = other[s : s + ENCODE_WORDS]
            ids, n = self._encode_other([words[i].decode() for i in part])
            found += _blocks(np.array(part), ids, n)
        return in_order(found, len(words))

    @staticmethod
    def _plain(words: list[bytes]) -> np.ndarray:
        """Which words are of printable ASCII without apostrophes and of Latin-1 letters, and not long.
        Those that may hold the name of a special token are not plain."""
        codes = np.frombuffer(b" ".join([*words, b""]), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        after, before = np.r_[codes[1:], 0], np.r_[0, codes[:-1]]
        ok = _ASCII[codes] | ((codes == 0xC3) & _LATIN[after]) | (_LATIN[codes] & (before == 0xC3))
        ok &= (codes != ord("<")) | (after != ord("|"))
        return np.logical_and.reduceat(ok | (codes == 32), np.cumsum(size + 1) - size - 1) & (size <= 64)

    def _merge_plain(self, words: list[bytes], at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Blocks of words and their ids: all parts of all words are merged at once."""
        text = b" ".join(words).translate(_LOWER)
        codes = np.frombuffer(text, np.uint8)
        tokens = _PARTS.findall(text)
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(size) - 1
        blank = codes[ends] == 32
        symbols = self.inside[codes]
        symbols[ends] = self.last[codes[ends]]
        (ids,), n = in_order(self.merges.merge(symbols[codes != 32], size[~blank]), int((~blank).sum()))
        # Parts follow each other in the order of the words: so do their ids.
        of = np.cumsum(blank)[~blank]
        return _blocks(at, ids, np.bincount(of, n, len(words)).astype(np.int64))

    def _encode_other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the tokenizer. The words are encoded as one text, parted by a special token: it
        treats what lies between as texts of their own. Words that hold that token's name are
        encoded one by one."""
        part = self.tokenizer.token_to_id(BETWEEN)
        if part is None or any(BETWEEN in w for w in words):
            made = [self._ids(w) for w in words]
            return np.array([i for x in made for i in x], np.int32), np.array([len(x) for x in made], np.int32)
        ids = np.array(self.tokenizer.encode_batch_fast([BETWEEN.join(words)], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(ids == part)
        return ids[ids != part], (np.diff(np.r_[-1, cuts, len(ids)]) - 1).astype(np.int32)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        found = self.memory([(t or "").encode().split() for t in texts])
        return [np.r_[ids, np.int32(END_ID)].astype("<u4") for (ids,) in found]


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32``.

    Whole texts are tokenized (null: empty), the end id added; only documents longer than
    ``sequence`` are cut.
    """

    def cut_up(doc_ids: list, texts: list, words: WordTokenizer) -> pa.RecordBatch:
        made = words(texts)
        size = np.array([len(ids) for ids in made], np.int64)
        n = -(-size // sequence)
        of = np.repeat(np.arange(len(made)), n)
        piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * sequence
        crc = [zlib.crc32(made[d][s : s + sequence].tobytes()) for d, s in zip(of.tolist(), start.tolist())]
        columns = [
            pa.array(doc_ids, pa.int64()).take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start),
            pa.array(np.minimum(sequence, size[of] - start)), pa.array(crc, pa.int64()),
        ]
        return pa.record_batch(columns, [f.split()[0] for f in PIECE_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One tokenizer and one memory of words per worker process: later tasks find them warm.
        words = of_process(f"words {tokenizer_path}", partial(WordTokenizer, tokenizer_path))
        for batch in batches:
            doc_ids, texts, chars = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_ids.append(doc_id.as_py())
                texts.append(text.as_py())
                chars += len(texts[-1] or "")
                if chars >= GROUP_CHARS:
                    yield cut_up(doc_ids, texts, words)
                    doc_ids, texts, chars = [], [], 0
            if doc_ids:
                yield cut_up(doc_ids, texts, words)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECE_SCHEMA)


def patterns(lengths: np.ndarray, sequence: int) -> np.ndarray:
    """Rows of three lengths (0: none), descending, that sum to ``sequence`` and occur."""
    has = np.zeros(sequence + 1, bool)
    has[lengths] = True
    has[0] = True
    one = np.array([[sequence, 0, 0]]) if has[sequence] else np.empty((0, 3), int)
    out = [one]
    for b in range(1, sequence // 2 + 1):
        if has[b]:
            c = np.arange(0, min(b, sequence - 2 * b) + 1)
            a = sequence - b - c
            good = has[c] & has[a] & (a >= b) & (a < sequence)
            out.append(np.stack([a[good], np.full(good.sum(), b), c[good]], axis=1))
    return np.concatenate(out)


def nnls_counts(rows: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """How often to use each pattern: non-negative least squares by accelerated projected
    gradient. Residuals of long lengths weigh more, as short pieces are easy to place later."""
    n = len(histogram)
    weight = (0.1 + np.arange(n) / n) / np.sqrt(np.maximum(histogram, 1.0))
    weight[0] = 0
    flat = rows.ravel()
    apply = lambda x: np.bincount(flat, np.repeat(x, 3), n)
    square = weight**2
    x = momentum_x = np.zeros(len(rows))
    # The largest eigenvalue, by power iteration, sets the step.
    v = np.ones(len(rows))
    for _ in range(20):
        v = (square * apply(v))[rows].sum(axis=1)
        norm = np.linalg.norm(v)
        if norm == 0:
            return x
        v /= norm
    step, t = 1 / (1.1 * norm), 1.0
    for _ in range(steps):
        slope = (square * (apply(momentum_x) - histogram))[rows].sum(axis=1)
        new = np.maximum(0, momentum_x - step * slope)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum_x = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x


def best_fit(left: np.ndarray, sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit, longest first, over a histogram: ``(lengths in order, how many sequences)``."""
    spaces: list[int] = []  # sorted free space of open groups
    groups: dict[int, list[list]] = {}

    def open_group(space: int, held: tuple[int, ...], n: int) -> None:
        if space not in groups:
            groups[space] = []
            insort(spaces, space)
        groups[space].append([held, n])

    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                each = max(1, min(todo, sequence // length))
                full, rest = divmod(todo, each)
                if full:
                    open_group(sequence - each * length, (length,) * each, full)
                if rest:
                    open_group(sequence - rest * length, (length,) * rest, 1)
                break
            space = spaces[at]
            held, n = groups[space].pop()
            if not groups[space]:
                del groups[space]
                spaces.pop(at)
            each = min(todo, space // length)
            full = min(n, todo // each)
            open_group(space - each * length, held + (length,) * each, full)
            if full < n:
                open_group(space, held, n - full)
            todo -= full * each
    return [(held, n) for space in groups.values() for held, n in space]


def plan(histogram: np.ndarray, sequence: int = SEQUENCE) -> dict[str, np.ndarray]:
    """Runs of pieces and their places, from the number of pieces of each length.

    Pieces ``first`` to ``first + count - 1`` of ``length`` go to sequences ``base`` onward, one
    each, at ``offset``. Arrays are sorted by length and first.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used: list[tuple[tuple[int, ...], int]] = []
    rows = patterns(np.flatnonzero(left), sequence)
    if len(rows):
        fitted = nnls_counts(rows, left.astype(float))
        for i in np.argsort(-fitted, kind="stable"):
            n = int(fitted[i])
            if n < 1:
                break
            held = tuple(x for x in rows[i].tolist() if x)
            n = min([n, *(int(left[x]) // held.count(x) for x in set(held))])
            if n:
                used.append((held, n))
                for x in held:
                    left[x] -= n
    used += best_fit(left, sequence)
    runs, seen, base = [], np.zeros(sequence + 1, np.int64), 0
    for held, n in used:
        offset = 0
        for x in held:
            runs.append((x, int(seen[x]), n, base, offset))
            seen[x] += n
            offset += x
        base += n
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "count", "base", "offset"), table.T)) | {"sequences": np.int64(base)}


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Every row of ``docs`` is packed, repeated rows too; null ids stay null; an empty table gives
    no rows; other columns are not read. Token work is done once and written; the driver sees
    only the histogram.
    """
    spark = docs.sparkSession
    # The salt, written with the row, spreads repeated rows; alike rows may swap places.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")
    table = cut(pieces(docs, tokenizer_path, sequence, id_col, text_col).select("*", salt), "pieces")
    buckets = max(partitions(spark), ceil(table.count() / BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(buckets)).cast("int")
    dealt = table.withColumn("bucket", bucket)
    # At most a row per length and bucket.
    counts = cut(dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(sequence + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    where = plan(histogram, sequence)
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # Past the bound both sides are dealt by length and bucket, which hold BUCKET_ROWS rows or so.
    before = F.broadcast(before) if counts.count() <= SMALL_ROWS else before
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "salt")
    numbered = dealt.withColumn("r", F.row_number().over(inside) - 1).join(before, ["length", "bucket"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") + F.col("before")).alias("rank"))
    # Length and rank as one sorted number: ranks stay below 2 ** 50.
    # A run for each place in each pattern used: under sequence ** 2 / 2 of them, 40 bytes each.
    shared = spark.sparkContext.broadcast(where | {"starts": (where["length"] << 50) + where["first"]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        starts = where["starts"]
        for batch in batches:
            rank = batch["rank"].to_numpy(zero_copy_only=False)
            key = (batch["length"].to_numpy(zero_copy_only=False) << 50) + rank
            at = np.searchsorted(starts, key, side="right") - 1
            sequence_id = where["base"][at] + rank - where["first"][at]
            columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.record_batch([*columns, pa.array(sequence_id), pa.array(where["offset"][at])], names)

    return numbered.mapInArrow(run, PIECE_SCHEMA + ", sequence_id bigint, offset bigint")
