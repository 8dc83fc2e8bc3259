"""Token ids in grammar-compressed binary shards.

Documents are range-sorted by id, encoded, closed with an end id and packed into
shards.  A shard is compressed by Re-Pair: the most frequent pairs of
neighbouring symbols become nonterminals, round after round.  A round replaces
up to ``RULES`` pairs at once, which numpy can do for a whole shard; pairs with the
end id are never replaced, so every document starts at a symbol.  The shard
keeps the rules and how many ids each symbol stands for; with both, any document
or range of ids is decoded without the rest of the shard.

Shard file: ``RPR1``, the length of a JSON header (4 bytes, little-endian), the
header with name, type and length of each array, then the arrays.

Defined cases: a null text is empty and holds the end id alone; null ids come
first; rows of equal id are ordered by a hash of their text, and rows equal in
both are written once each; an empty table gives no shards and an empty result;
other columns are ignored.  A document longer than a shard gets a shard of its own.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import files
from shiftledger.llm.common import shared_folder, small_batches, small_frame, written

END_ID = 2
#: Ids in a shard, about.
SHARD_IDS = 1 << 21
#: Rounds of pair replacement, pairs replaced in one, and how often a pair occurs at least.
ROUNDS = 4
RULES = 2048
MIN_COUNT = 32
#: Bytes of texts and different words of them that are encoded at once, about.
TEXT_AT_ONCE = 1 << 23
WORDS_AT_ONCE = 4096
#: Different words whose ids a worker process keeps, at most.
KNOWN_WORDS = 1 << 20
#: Bytes of rows that Spark hands to a worker at once, about.
BATCH_BYTES = 1 << 22
#: Elements that numpy's temporary arrays of positions hold, about.
AT_ONCE = 1 << 16
MAGIC = b"RPR1"
_BUCKETS = 1 << 18
_SHIFT = np.uint32(14)

_MANIFEST = "shard string, part int, base long, ids long"


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``ids`` numbered ``at``, one after the other, and where each ends."""
    ends = np.cumsum(sizes[at], dtype=np.int64)
    found = np.empty(ends[-1] if len(ends) else 0, ids.dtype)
    low = 0
    for first in range(0, len(at), AT_ONCE):
        piece = at[first : first + AT_ONCE]
        until = ends[first : first + AT_ONCE]
        widths = sizes[piece]
        shift = starts[piece] - (until - widths)
        high = int(until[-1])
        found[low:high] = ids[np.repeat(shift, widths) + np.arange(low, high)]
        low = high
    return found, ends


class WordIds:
    """Ids of texts; each different word is encoded once, and again only when forgotten.

    Words are kept from text to text, up to ``KNOWN_WORDS``; when there are more,
    all but those of the texts at hand are forgotten.

    For tokenizers that never join characters across white space, ignore the case
    of ASCII letters and keep a run of marks apart from letters before it.
    """

    def __init__(self, path: str) -> None:
        # a task has one core; threads of the library would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # which ids end a run of letters, if the vocabulary tells
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.string())
        self._ids, self._sizes = np.zeros(0, "<u4"), np.zeros(0, np.int32)

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [f.ids for f in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.array([len(ids) for ids in found], np.int32)
        return np.array([i for ids in found for i in ids], "<u4"), sizes

    def _as_one_text(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters, cut where ids end them."""
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._one_by_one(words)
        return ids, np.diff(ends, prepend=0).astype(np.int32)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where words are among those known; encodes the others."""
        asked = words.unique()
        # the hash table is that of the few words asked for, not of all known
        held = pc.index_in(self._known, value_set=asked)
        there = np.flatnonzero(held.is_valid())
        places = np.full(len(asked), -1, np.int64)
        places[held.drop_null().to_numpy()] = there
        missing = np.flatnonzero(places < 0)
        if len(self._known) and len(self._known) + len(missing) > KNOWN_WORDS:
            self._forget()
            return self._places(words)
        new = asked.take(pa.array(missing))
        letters = pc.utf8_is_alpha(new)
        plain, other = new.filter(letters), new.filter(pc.invert(letters))
        parts = [
            encode(some.slice(low, WORDS_AT_ONCE).to_pylist())
            for some, encode in ((plain, self._as_one_text), (other, self._one_by_one))
            for low in range(0, len(some), WORDS_AT_ONCE)
        ]
        if parts:
            apart = letters.to_numpy(zero_copy_only=False)
            places[np.concatenate([missing[apart], missing[~apart]])] = len(self._known) + np.arange(len(new))
            self._known = pa.concat_arrays([self._known, plain, other])
            self._ids, self._sizes = (
                np.concatenate([held, *p])
                for held, p in zip((self._ids, self._sizes), zip(*parts, strict=True), strict=True)
            )
        return places[pc.index_in(words, value_set=asked).to_numpy()]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, where those of each start, and how many they are."""
        letters = pc.ascii_rtrim(words, characters=string.punctuation)
        # a letter that normalises or, as only this one does, lower-cases to more than letters
        # could join the marks behind it
        plain = pc.utf8_is_alpha(pc.utf8_normalize(letters, form="NFC"))
        plain = pc.and_(plain, pc.invert(pc.match_substring(letters, "İ")))
        marked = pc.and_(plain, pc.not_equal(pc.binary_length(words), pc.binary_length(letters)))
        heads = pc.if_else(plain, pc.ascii_lower(letters), words).dictionary_encode()
        pairs = zip(words.filter(marked).to_pylist(), letters.filter(marked).to_pylist(), strict=True)
        tails = pa.array([word[len(head) :] for word, head in pairs], pa.string()).dictionary_encode()

        parts = [heads.dictionary, tails.dictionary, pa.array([""])]
        at = self._places(pa.concat_arrays([part.cast(pa.string()) for part in parts]))
        # each word is a head and a tail, which is empty for most
        both = np.full((len(words), 2), at[-1])
        both[:, 0] = at[heads.indices.to_numpy()]
        both[marked.to_numpy(zero_copy_only=False), 1] = at[len(heads.dictionary) + tails.indices.to_numpy()]
        starts = np.cumsum(self._sizes, dtype=np.int64)
        starts -= self._sizes
        flat, ends = _gathered(self._ids, starts, self._sizes, both.ravel())
        ends = ends[1::2]
        sizes = np.diff(ends, prepend=0)
        return flat, ends - sizes, sizes

    def _texts(self, texts: pa.Array) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts, one after the other, and where each text ends."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        flat, ends = _gathered(*self._words(coded.dictionary), coded.indices.to_numpy())
        return flat, np.concatenate([[0], ends])[np.cumsum(split.value_lengths().to_numpy())].tolist()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text as little-endian bytes."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy()) // TEXT_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high > low:
                # while the caller packs a shard, this holds no more than the ids
                flat, ends = self._texts(texts.slice(low, high - low))
                yield from (flat[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False))


@cache
def word_ids(path: str) -> WordIds:
    """One per worker process, kept from task to task."""
    return WordIds(path)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique`` with inverse and counts, but sorts only the different codes."""
    coded = pa.array(codes).dictionary_encode()
    different = coded.dictionary.to_numpy()
    order = np.argsort(different)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    code = place[coded.indices.to_numpy()]
    return different[order], code, np.bincount(code, minlength=len(order))


def compress(
    ids: np.ndarray, first: int, end_id: int = END_ID,
    rounds: int = ROUNDS, rules: int = RULES, min_count: int = MIN_COUNT,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (pairs; the n-th defines symbol ``first + n``), their expansion lengths."""
    symbols = ids.astype(np.uint32)
    found = np.empty((0, 2), np.int64)
    lengths = np.empty(0, np.int64)
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        left, right = symbols[:-1], symbols[1:]
        # a count per hash bucket is never below that of a pair in it, so light buckets are skipped
        bucket = left * np.uint32(0x9E3779B1)
        bucket += right * np.uint32(0x85EBCA77)
        bucket >>= _SHIFT
        pieces = [slice(low, low + 4 * AT_ONCE) for low in range(0, len(bucket), 4 * AT_ONCE)]
        heavy = sum(np.bincount(bucket[piece], minlength=_BUCKETS) for piece in pieces)
        level = max(min_count, int(np.partition(heavy, -rules)[-rules]))
        may = (left != end_id) & (right != end_id)
        for piece in pieces:
            may[piece] &= (heavy >= level)[bucket[piece]]
        at = np.flatnonzero(may)
        if not len(at):
            break
        codes = left[at].astype(np.int64)
        codes <<= 32
        codes |= right[at]
        pairs, code, counts = _counted(codes)
        del bucket, may, codes
        best = np.argsort(-counts, kind="stable")[:rules]
        chosen = np.zeros(len(pairs), bool)
        chosen[best[counts[best] >= min_count]] = True
        kept = chosen[code]
        at, code = at[kept], code[kept]
        if not len(at):
            break
        # in a run of overlapping pairs, every second one from its start
        begins = np.diff(at, prepend=-2) > 1
        order = np.arange(len(at))
        start = np.where(begins, order, 0)
        order -= np.maximum.accumulate(start, out=start)
        taken = order % 2 == 0
        del begins, order, start
        at, code = at[taken], code[taken]
        present = np.bincount(code, minlength=len(pairs)) > 0
        used, slot = np.flatnonzero(present), (np.cumsum(present) - 1)[code]
        made = np.stack([pairs[used] >> 32, pairs[used] & 0xFFFFFFFF], axis=1)
        both = np.concatenate([np.ones(first, np.int64), lengths])[made].sum(axis=1)
        symbols[at] = first + len(found) + slot
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols = symbols[kept]
        found, lengths = np.concatenate([found, made]), np.concatenate([lengths, both])
    return symbols, found, lengths


class Grammar:
    """Expands symbols to ids.  The expansions of all rules lie in one array."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, first: int) -> None:
        self.widths = np.concatenate([np.ones(first, np.int64), lengths])
        self._starts = np.concatenate([np.arange(first), first + np.cumsum(lengths) - lengths])
        self._ids = np.concatenate([np.arange(first), np.empty(int(lengths.sum()), np.int64)]).astype("<u4")
        starts, widths, ids = self._starts.tolist(), self.widths.tolist(), self._ids
        for n, (left, right) in enumerate(rules.tolist(), first):
            at, middle = starts[n], starts[n] + widths[left]
            ids[at:middle] = ids[starts[left] : starts[left] + widths[left]]
            ids[middle : at + widths[n]] = ids[starts[right] : starts[right] + widths[right]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return _gathered(self._ids, self._starts, self.widths, symbols)[0]


def pack(doc_ids: list[int | None], texts: list[bytes], first: int, end_id: int) -> bytes:
    """A shard file of encoded documents without their end ids."""
    end = np.array([end_id], "<u4").tobytes()
    ids = np.frombuffer(end.join([*texts, b""]), "<u4")
    first = max(first, int(ids.max()) + 1)
    symbols, rules, lengths = compress(ids, first, end_id)
    sizes = np.array([len(t) // 4 + 1 for t in texts], np.int64)
    widths = np.concatenate([np.ones(first, np.int64), lengths])[symbols]
    id_starts = np.concatenate([[0], np.cumsum(sizes)])
    symbol_starts = np.searchsorted(np.concatenate([[0], np.cumsum(widths)]), id_starts)
    small = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
    arrays = {
        "doc_ids": np.array([0 if d is None else d for d in doc_ids], "<i8"),
        "known": np.array([d is not None for d in doc_ids], "u1"),
        "id_starts": id_starts.astype("<i8"),
        "symbol_starts": symbol_starts.astype("<i8"),
        "rules": rules.ravel().astype("<u4"),
        "lengths": lengths.astype("<u4"),
        "symbols": symbols.astype(np.dtype(small).newbyteorder("<")),
    }
    layout = [[name, a.dtype.str, len(a)] for name, a in arrays.items()]
    header = json.dumps({"first": first, "end_id": end_id, "arrays": layout}).encode()
    head = MAGIC + len(header).to_bytes(4, "little") + header
    return head + b"".join(a.tobytes() for a in arrays.values())


class Shard:
    """A shard file opened for random access."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        at = 8 + int.from_bytes(data[4:8], "little")
        header = json.loads(data[8:at])
        self.first, self.end_id = header["first"], header["end_id"]
        for name, kind, length in header["arrays"]:
            array = np.frombuffer(data, kind, length, at)
            at += array.nbytes
            setattr(self, name, array)
        self.grammar = Grammar(self.rules.reshape(-1, 2), self.lengths.astype(np.int64), self.first)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def doc_id(self, n: int) -> int | None:
        return int(self.doc_ids[n]) if self.known[n] else None

    def document(self, n: int) -> np.ndarray:
        """Ids of the n-th document, end id included."""
        low, high = self.symbol_starts[n], self.symbol_starts[n + 1]
        return self.grammar.expand(self.symbols[low:high])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to before ``stop`` of the shard; expands only the symbols they touch."""
        n = max(0, int(np.searchsorted(self.id_starts, start, "right")) - 1)
        low = int(self.symbol_starts[n])
        last = int(np.searchsorted(self.id_starts, stop, "left"))
        high = int(self.symbol_starts[min(last, len(self))])
        ends = self.id_starts[n] + np.cumsum(self.grammar.widths[self.symbols[low:high]])
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = start - (int(ends[a - 1]) if a else int(self.id_starts[n]))
        found = self.grammar.expand(self.symbols[low + a : low + b])
        return found[skipped : skipped + stop - start]


def write_shards(
    documents: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID,
    shard_ids: int = SHARD_IDS, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write shards in ascending order of ids; returns a manifest.

    ``base`` is the number of ids before the shard in its partition.
    """
    rows = documents.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = word_ids(tokenizer)
        first = words.tokenizer.get_vocab_size()
        part = TaskContext.get().partitionId()
        keys: list[int | None] = []
        texts: list[bytes] = []
        base = held = number = 0

        def flush() -> pa.RecordBatch:
            # what encoding took is free for packing
            pa.default_memory_pool().release_unused()
            name = files.attempt_name("shard", number, ".rpr")
            with files.output(folder, name) as out:
                out.write(pack(keys, texts, first, end_id))
            arrays = [pa.array([f"{folder}/{name}"]), pa.array([part], pa.int32())]
            arrays += [pa.array([n], pa.int64()) for n in (base, held)]
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "part", "base", "ids"])

        for batch in batches:
            encodings = words.encode(batch.column(1))
            for key, encoded in zip(batch.column(0).to_pylist(), encodings, strict=True):
                if held and held + len(encoded) // 4 + 1 > shard_ids:
                    yield flush()
                    keys, texts, base, held, number = [], [], base + held, 0, number + 1
                keys.append(key)
                texts.append(encoded)
                held += len(encoded) // 4 + 1
        if keys:
            yield flush()

    with small_batches(documents.sparkSession, BATCH_BYTES):
        return written(ordered.mapInArrow(write, _MANIFEST), "shards")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the shards.

    The driver sums up one number per partition that wrote.
    """
    totals = sorted(tuple(r) for r in manifest.groupBy("part").agg(F.sum("ids")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in totals])]).astype(np.int64)
    starts = small_frame(
        manifest.sparkSession,
        {
            "part": pa.array([p for p, _ in totals], pa.int32()),
            "before": pa.array(before[: len(totals)], pa.int64()),
        },
    )
    placed = manifest.join(F.broadcast(starts), "part").select(
        "shard", (F.col("before") + F.col("base")).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.input_stream(row["shard"]) as raw:
                    shard = Shard(raw.read())
                ids = shard.grammar.expand(shard.symbols)
                at = shard.id_starts.tolist()
                spans = list(zip(at, at[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.doc_id(n) for n in range(len(shard))], pa.int64()),
                        pa.array([row["start"] + low for low, _ in spans], pa.int64()),
                        pa.array([high - low for low, high in spans], pa.int64()),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.repartition(max(1, placed.count())).mapInArrow(read, schema)


def encoded_documents(
    documents: DataFrame, tokenizer: str, folder: str | None = None, **options
) -> DataFrame:
    """Write all documents as shards and read the digest of each back."""
    folder = folder or shared_folder(documents.sparkSession, "tokens")
    return read_shards(write_shards(documents, tokenizer, folder, **options))
