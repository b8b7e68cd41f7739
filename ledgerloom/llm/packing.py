"""Best-fit packing into sequences of fixed length, certified by dual-feasible-function bounds.

Documents are tokenised, closed with a separator id and cut only where they are longer than a sequence. Full
pieces are sequences of their own. The others are dealt evenly to partitions and packed by best-fit
decreasing. The lengths of a partition give a lower bound on its sequences; where the bound is met the packing
is certified and gives back only its emptiest sequence. A partition with a gap gives back every sequence that
has room. What came back is dealt anew, to fewer partitions, until one partition or nothing is left.

* null text counts as empty: a document of the separator alone;
* repeated rows are packed each for itself; a null ``doc_id`` stays null;
* very long texts are encoded word by word, so memory follows the ids of one document;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import Scratch

CAPACITY = 2048
SEPARATOR = 0
DEALT = 4_000  # pieces a partition packs
CACHED_WORDS = 120_000

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset int, certified boolean, back boolean"

#: Printable ASCII and Latin-1 letters: such words are already in normal form, and each is lower-cased alone.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: How a vocabulary file must say that texts are normalised and split for the way word by word.
BY_WORD = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: The same split, for plain characters.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordEncoder:
    """Ids by a public vocabulary file, word by word, with a bounded memory of words seen.

    White space never takes part in a token here, so the ids of a text are those of its words in turn. Plain
    words go straight to the vocabulary's merge step; all others, and the names of special tokens, through
    the whole tokenizer. A vocabulary whose file states other rules than ``BY_WORD`` encodes whole texts.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        stated = json.loads(self.tokenizer.to_str())
        self.by_word = all(stated[name] == rules for name, rules in BY_WORD.items())
        self.cached = cached
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [byte for byte in range(256) if byte not in kept]
        self.letters = {byte: chr(byte) for byte in kept} | {byte: chr(256 + k) for k, byte in enumerate(moved)}

    def _look_up(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            text = word.decode()
            if _PLAIN.fullmatch(text) and "<|" not in text:
                ids = []
                for part in _SPLIT.findall(text.lower()):
                    if not part.isascii():
                        part = part.encode().decode("latin-1").translate(self.letters)
                    ids += [token.id for token in self.merge(part)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = np.array(ids, "<u4").tobytes()
        if len(self.words) >= self.cached:
            self.older, self.words = self.words, {}
        self.words[word] = found
        return found

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.by_word:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        get, look_up = self.words.get, self._look_up
        ids = []
        for word in text.lower().split():
            found = get(word)
            if found is None:
                found = look_up(word)
                get = self.words.get
            ids.append(found)
        return b"".join(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR, keep_ids: bool = False
) -> DataFrame:
    """One row per piece of a document; with ``keep_ids`` also its token ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([separator], "<u4").tobytes()
        for batch in batches:
            rows, ids_of = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or b"") + end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)))
                    if keep_ids:
                        ids_of.append(np.frombuffer(part, "<u4").astype(np.int32))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            if keep_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<int>" if keep_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: sequence and offset of every piece, and the room left in every sequence.

    Sequences are kept by the room they have left; a bit mask of the rooms in use gives the tightest fit.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int32)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, room = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = used >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            target = by_room[left].pop()
            if not by_room[left]:
                used &= ~(1 << left)
        else:
            left, target = capacity, len(room)
            room.append(capacity)
        bins[item], offsets[item] = target, capacity - left
        room[target] = left = left - length
        if left:
            by_room[left].append(target)
            used |= 1 << left
    return bins, offsets, np.array(room, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of sequences, by two families of dual feasible functions.

    One counts pieces above capacity - t as whole sequences and leaves out those below t; the other rounds
    lengths to k-ths of a sequence. The sum of either, rounded up, bounds every packing from below.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    pieces_to, tokens_to = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    whole = pieces_to[-1] - pieces_to[capacity - t]
    rest = tokens_to[capacity - t] - tokens_to[t - 1]
    best = int((whole + -(-rest // capacity)).max())
    for k in range(1, 33):
        scaled = (k + 1) * size
        even = scaled % capacity == 0
        # in units of 1 / (k * capacity), so that both cases stay whole numbers
        value = np.where(even, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return max(best, -(-int(tokens_to[-1]) // capacity))


def _packer(capacity: int, turn: int):
    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("uid")
        part = rows.column("part")[0].as_py()
        lengths = rows.column("length").to_numpy().astype(np.int64)
        bins, offsets, room = best_fit(lengths, capacity)
        certified = len(room) == lower_bound(lengths, capacity)
        back = room > 0
        if certified:
            emptiest = int(room.argmax())
            back = (np.arange(len(room)) == emptiest) & back
        more = {
            "sequence_id": pa.array((turn << 56) + (part << 24) + bins),
            "offset": pa.array(offsets),
            "certified": pa.array(np.full(len(bins), certified)),
            "back": pa.array(back[bins]),
        }
        out = rows.drop_columns(["part"])
        for name, values in more.items():
            out = out.append_column(name, values)
        return out

    return fit


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    dealt: int = DEALT,
) -> DataFrame:
    """Pieces with the sequence they go to, their offset there, and whether that packing met its bound.

    Partitions with gaps exchange documents as long as a round needs fewer sequences than the one before.
    Memory of a task is bounded by ``dealt`` pieces, about; only numbers of pieces come to the driver.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(
        pieces(docs, vocabulary, capacity, separator).withColumn("uid", F.monotonically_increasing_id()), "pieces"
    )
    full = rows.where(F.col("length") == capacity).select(
        *[name for name in rows.columns if name != "uid"],
        (-1 - F.col("uid")).alias("sequence_id"),
        F.lit(0).alias("offset"),
        F.lit(True).alias("certified"),
    )
    results, pool = [full], rows.where(F.col("length") < capacity)
    left = pool.count()
    turn, before = 0, None
    while left:
        parts = -(-left // dealt)
        part = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts))
        packed = scratch.store(
            pool.withColumn("part", part).groupBy("part").applyInArrow(
                _packer(capacity, turn), f"{PIECES}, uid long, {PACKED.removeprefix(PIECES + ', ')}"
            ),
            "packed",
        )
        first = F.col("offset") == 0  # one piece of every sequence
        made, left, again = packed.agg(F.count_if(first), F.count_if("back"), F.count_if(first & F.col("back"))).first()
        stuck = before is not None and made >= before
        last = parts == 1 or not left or stuck
        results.append((packed if last else packed.where("not back")).select(*full.columns))
        if last:
            break
        pool, before, turn = packed.where("back").select(*rows.columns), again, turn + 1
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
