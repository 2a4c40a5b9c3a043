"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

A sequence costs what attention over its pieces costs: a part linear in tokens and a part quadratic in each piece's
length. Every task packs its rows window by window: whole sequences are cut from documents longer than a
sequence; the rests, in descending length, go to the sequence of lowest cost that has room. As documents may be
cut, a rest that fits nowhere is cut into the room that is left, and what exceeds the last full sequence goes to
sequences whose lengths are powers of two. So no sequence has padding, windows need no shuffle, and memory is
bounded by a window and the longest document. The same input partitions give the same sequences.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Punctuation that always ends a run of letters, so that the letters before it can be encoded alone.
STOPS = ".,|!?;:"
#: Words whose ids a worker remembers; beyond that it starts anew.
REMEMBERED = 300_000


class WordIds:
    """Ids of texts by a word-level BPE file, remembered by word.

    White space separates words in such a tokenizer, so a text's ids are those of its words in order. A plain
    lower-case word is merged by tiktoken, which is several times faster at the same merges: with a blank for the
    mark of a word's end, as no word holds one, it merges by the order of ids, and ids are in the order of merges.
    All else goes through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        special = {t.content for t in self.full.get_added_tokens_decoder().values()}
        # byte-level alphabet: bytes that print stand for themselves, the others for characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        mark = model["end_of_word_suffix"]
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in special:
                end = token.endswith(mark)
                ranks[bytes(byte[c] for c in (token.removesuffix(mark) if end else token)) + b" " * end] = i
        self.merge = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.ends[[i for b, i in ranks.items() if len(b) > 1 and b.endswith(b" ")]] = True
        self.known: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        known = self.known
        parts: dict[str, tuple[str, str]] = {}
        plain: set[str] = set()
        other: set[str] = set()
        for w in new:
            core = w.rstrip(STOPS)
            low = core.lower() if core.isascii() else core
            if low.isalpha() and low == low.lower() and (core.isascii() or unicodedata.is_normalized("NFC", low)):
                parts[w] = low, w[len(core) :]
                plain.add(low)
                other.add(w[len(core) :])
            else:
                other.add(w)
        group = [w for w in plain if w not in known]
        if group:
            ids = np.array(self.merge.encode_ordinary(" ".join(group) + " "), dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            line = ids.tobytes()
            known.update(zip(group, (line[a:b] for a, b in zip([0, *cuts], cuts))))
        group = [w for w in other if w not in known]
        for w, e in zip(group, self.full.encode_batch(group, add_special_tokens=False)):
            known[w] = np.array(e.ids, dtype="<u4").tobytes()
        for w, (low, rest) in parts.items():
            known[w] = known[low] + known[rest]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        out, known = [], self.known
        for text in texts:
            # split() would also cut at white space that the tokenizer may not know as such
            listed = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            try:
                out.append(b"".join([known[w] for w in listed]))
            except KeyError:
                if len(known) > REMEMBERED:
                    known.clear()
                self.learn([w for w in set(listed) if w not in known])
                out.append(b"".join([known[w] for w in listed]))
        return out


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pack_window(lengths: np.ndarray, size: int, quadratic: float) -> tuple[np.ndarray, ...]:
    """Cut and place documents of the given lengths: arrays (document, start, length, sequence, offset) and the
    length of each sequence."""
    whole = lengths // size
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) * size
    rows = [(doc, start, np.full(len(doc), size), np.arange(len(doc)), np.zeros(len(doc), dtype=np.int64))]
    used = len(doc)
    rest = lengths - whole * size
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0]
    n = int(rest.sum()) // size
    room, cost = np.full(n, size), np.zeros(n)
    placed: list[tuple[int, int, int, int, int]] = []
    held: list[int] = []

    def put(d: int, at: int, k: int, s: int) -> None:
        placed.append((d, at, k, used + s, size - int(room[s])))
        room[s] -= k
        cost[s] += k + quadratic * k * k

    for d in order.tolist():
        k = int(rest[d])
        s = int(np.where(room >= k, cost, np.inf).argmin()) if n else 0
        if n and room[s] >= k:
            put(d, int(whole[d]) * size, k, s)
        else:
            held.append(d)
    open_ = np.flatnonzero(room)
    gaps = open_[np.argsort(cost[open_], kind="stable")].tolist()[::-1]
    tail: list[tuple[int, int, int]] = []
    for d in held:
        at, k = int(whole[d]) * size, int(rest[d])
        while k and gaps:
            s = gaps[-1]
            take = min(k, int(room[s]))
            put(d, at, take, s)
            at, k = at + take, k - take
            if not room[s]:
                gaps.pop()
        if k:
            tail.append((d, at, k))
    sizes = [size] * (used + n)
    left = sum(k for _, _, k in tail)
    pieces = iter(tail)
    d, at, k = next(pieces, (0, 0, 0))
    while left:
        power = 1 << (left.bit_length() - 1)
        fill = 0
        while fill < power:
            take = min(k, power - fill)
            placed.append((d, at, take, len(sizes), fill))
            fill, at, k = fill + take, at + take, k - take
            if not k:
                d, at, k = next(pieces, (0, 0, 0))
        sizes.append(power)
        left -= power
    rows.append(tuple(np.array(placed, dtype=np.int64).reshape(-1, 5).T))
    return (*(np.concatenate(c) for c in zip(*rows)), np.array(sizes, dtype=np.int64))


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    end_id: int = 1,
    quadratic: float = 1 / 1024,
    window_tokens: int = 1 << 21,
) -> DataFrame:
    """Pack all documents; one row per piece: key, start, length, doc_tokens, sequence_id, offset,
    sequence_tokens and ids (little-endian 32-bit integers).

    A document is its ids and `end_id`; a null or empty text is that id alone. `quadratic` is the cost of a squared
    token against that of a token. Keys are only passed on: null and repeated keys are documents of their own. An
    empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_ids(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        task, sequences = TaskContext.get().partitionId(), 0
        keys: list[pa.Array] = []
        ids: list[bytes] = []
        tokens = 0

        def window() -> Iterator[pa.RecordBatch]:
            nonlocal sequences, tokens
            lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            doc, start, length, seq, offset, sizes = pack_window(lengths, size, quadratic)
            names = pa.concat_arrays(keys)
            for lo in range(0, len(doc), 2000):
                d, s, k = doc[lo : lo + 2000], start[lo : lo + 2000], length[lo : lo + 2000]
                q = seq[lo : lo + 2000]
                columns = [
                    names.take(pa.array(d)), pa.array(s), pa.array(k), pa.array(lengths[d]), pa.array((task << 33) + sequences + q),
                    pa.array(offset[lo : lo + 2000]), pa.array(sizes[q]),
                    pa.array([ids[i][4 * a : 4 * (a + n)] for i, a, n in zip(d.tolist(), s.tolist(), k.tolist())], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            sequences += len(sizes)
            keys.clear()
            ids.clear()
            tokens = 0

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                new = [x + end for x in encode(part.column(1).to_pylist())]
                keys.append(part.column(0))
                ids.extend(new)
                tokens += sum(map(len, new)) // 4
                if tokens >= window_tokens:
                    yield from window()
        if ids:
            yield from window()

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)])
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens"):
        schema.add(name, T.LongType())
    schema.add("ids", T.BinaryType())
    return docs.select(key, text).mapInArrow(run, schema)
