"""Byte-level BPE by a global shuffle of distinct words.

Encoding:

1. Texts are cut into words (pre-tokens).  A task gathers documents into
   chunks; a chunk is its words, each once, and the place of each of its
   tokens among them.  So a word crosses the network once per chunk, however
   often a text repeats it, and no word is hot.
2. The words of all chunks are exploded and shuffled by word: by one of
   ``BUCKETS`` hash buckets, and a chunk's words of a bucket travel as one
   row, as rows of a single word would be mostly overhead.  All requests for
   a word meet, each distinct word is merged once, and its ids go back to
   every chunk that asked.
3. Chunks and the ids of their words are joined by chunk and put together by
   position, document by document.

Decoding explodes the distinct ids of a chunk of documents with their
positions, joins the token-byte table (one row per token of the vocabulary:
broadcast, its size does not depend on the data) and puts the bytes together
by position.  It does not shuffle.

Words are cut as ``tiktoken`` cuts them: the library is asked once per worker
which characters it holds for letters, digits and white space, as Unicode
versions differ.

Defined cases: a null text is empty and has no tokens; texts of any length
are whole; repeated rows and null ids are documents of their own; special
strings are ordinary text; a token id without bytes decodes to none; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from bundlelake.llm.packing import SPLIT
from bundlelake.llm.textnum import Rolling
from bundlelake.llm.tokencount import OTHER, PIECES

CHUNK_CHARS = 6 << 20    # text of a chunk; one longer text is a chunk of its own
BUCKETS = 1024           # of words; a task holds one bucket's distinct words at a time
SLICE_CHARS = 1 << 18    # of a long text cut into words at a time
CHUNK_IDS = 1 << 20      # tokens decoded together
PART_BITS = 12           # a chunk's documents have at most 4 * CHUNK_CHARS tokens, hence some 50 parts


@lru_cache(maxsize=4)
def ranks_of(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Splitter:
    """Words of a text, as ``tiktoken`` matches the pattern."""

    # a word starts at white space after other characters, whatever stands before
    _SAFE = regex.compile(r"(?<=\S)\s")

    def __init__(self, pattern: str):
        import tiktoken

        single = {bytes([b]): b for b in range(256)}
        every = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4").tobytes().decode("utf-32-le")
        exact, differing = pattern, np.zeros(0, np.uint32)
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            theirs = self._codes(bytes(tiktoken.Encoding("one", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
            ours = self._codes(regex.sub(f"[^{name}]+", "", every))
            for extra, sign in ((np.setdiff1d(theirs, ours), "||"), (np.setdiff1d(ours, theirs), "--")):
                if extra.size:
                    exact = exact.replace(name, f"[{name}{sign}{self._set(extra)}]")
                    differing = np.union1d(differing, extra)
        self.plain, self.exact = regex.compile(pattern), regex.compile("(?V1)" + exact)
        self.differing = regex.compile(self._set(differing)) if differing.size else None
        self.latin = PIECES if pattern == SPLIT else None  # the same rules below U+0250

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)

    @staticmethod
    def _set(codes: np.ndarray) -> str:
        runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)  # of consecutive characters
        return "[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "]"

    def __call__(self, text: str) -> Iterator[list[str]]:
        """Lists of consecutive words."""
        if self.latin is not None and not OTHER.search(text):
            words = self.latin
        elif self.differing is None or not self.differing.search(text):
            words = self.plain
        else:
            words = self.exact
        at = 0
        while at < len(text):
            cut = self._SAFE.search(text, at + SLICE_CHARS) if len(text) - at > 2 * SLICE_CHARS else None
            end = cut.start() if cut else len(text)
            yield words.findall(text[at:end])
            at = end


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    """One per worker process and pattern."""
    return Splitter(pattern)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: neighbours whose joint bytes have the lowest rank are
    joined first, the leftmost of equal ones."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))             # of the symbol that starts here
    before, gone = list(range(-1, n - 1)), [False] * n

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    heap: list = []
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, last = heapq.heappop(heap)
        j = end[i]
        if gone[i] or j >= n or end[j] != last:
            continue  # one of the two has been joined since
        end[i], gone[j] = last, True
        if last < n:
            before[last] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(values) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, first bytes
    before second ones, compressed."""
    values = np.asarray(values, np.uint32)
    size = next(k for k in (1, 2, 4) if not values.size or values.max() < 1 << 8 * k)
    return bytes([size]) + _zip(values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(_unzip(data[1:]), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64)


def _chunks(pattern: str, kind: pa.DataType):
    """(id, text) -> chunks: ids, tokens per document, token places, words.
    Places and words are packed, as they cross the network with their chunk."""
    def run(batches):
        split, key = splitter(pattern), TaskContext.get().partitionId() << 32
        ids, sizes, places, slots, chars = [], [], [], _Slots(), 0

        def chunk():
            words = [w.encode() for w in slots]
            packed = _pack(np.concatenate([np.zeros(0, np.uint32), *places])), _zip(b"".join(words)), _pack([len(w) for w in words])
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())),
                 *(pa.array([x], pa.binary()) for x in packed)], names=["chunk", "ids", "sizes", "places", "words", "word_sizes"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if ids and chars + len(text) > CHUNK_CHARS:
                    yield chunk()
                    key += 1
                    ids, sizes, places, slots, chars = [], [], [], _Slots(), 0
                n = 0
                for words in split(text):
                    places.append(np.fromiter(map(slots.__getitem__, words), np.uint32, len(words)))
                    n += len(words)
                ids.append(i)
                sizes.append(n)
                chars += len(text)
        if ids:
            yield chunk()
    return run


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The given stretches of ``data`` behind one another."""
    end = np.cumsum(length)
    return data[np.repeat(start - (end - length), length) + np.arange(end[-1] if end.size else 0)]


def _dealt(row: dict, buckets: int):
    """Words of a chunk by bucket: (bytes, start and size of every word, the
    words in the order of their buckets, their buckets)."""
    body, size = np.frombuffer(_unzip(row["words"]), np.uint8), _unpack(row["word_sizes"])
    start = np.cumsum(size) - size
    bucket = (Rolling(body).of(start, start + size) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return body, start, size, order, bucket[order]


def _requests(buckets: int):
    """The words of each chunk, a row for each bucket that has some."""
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):  # one chunk at a time, and of it the words only
                row = {c: b.column(c)[r].as_py() for c in ("chunk", "words", "word_sizes")}
                body, start, size, order, bucket = _dealt(row, buckets)
                start, size = start[order], size[order]
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                runs = list(zip(first.tolist(), [*first[1:].tolist(), bucket.size]))
                words = [_zip(_gather(body, start[i:j], size[i:j]).tobytes()) for i, j in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(first.size, row["chunk"])), pa.array(bucket[first]), pa.array(words, pa.binary()),
                     pa.array([_pack(size[i:j]) for i, j in runs], pa.binary())], names=["chunk", "bucket", "words", "word_sizes"])
    return run


def _answers(vocabulary: str):
    """Rows come sorted by bucket.  All requests for a word are in one
    bucket, whose words are remembered, so each distinct one is merged once."""
    def run(batches):
        ranks, now, known = ranks_of(vocabulary), None, {}
        for b in (x.slice(s, 1024) for x in batches for s in range(0, x.num_rows, 1024)):
            ids, counts = [], []
            for bucket, body, sizes in zip(*(b.column(c).to_pylist() for c in (1, 2, 3))):
                if bucket != now:
                    now, known = bucket, {}
                found, body, at = [], _unzip(body), 0
                for n in _unpack(sizes).tolist():
                    word = body[at:at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        got = known[word] = merged(word, ranks)
                    found.append(got)
                ids.append(_pack([x for f in found for x in f]))
                counts.append(_pack([len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["chunk", "bucket", "ids", "counts"])
    return run


def _together(buckets: int, parts: bool = False):
    """The ids of a chunk's documents, by the places of their tokens; or the
    parts that decoding starts from (a chunk has few: see ``PART_BITS``)."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        docs, row = chunk.column("ids")[0].values, {c: chunk.column(c)[0].as_py() for c in ("sizes", "places", "words", "word_sizes")}
        *_, order, _ = _dealt(row, buckets)
        answers = answers.sort_by("bucket")
        ids, count = (np.concatenate([np.zeros(0, np.int64), *map(_unpack, answers.column(c).to_pylist())]) for c in ("ids", "counts"))
        length, start = np.zeros(order.size, np.int64), np.zeros(order.size, np.int64)  # by the word's place
        length[order], start[order] = count, np.cumsum(count) - count
        places, ids, out, first = _unpack(row["places"]), ids.astype(np.uint32), [], 0
        for n in row["sizes"]:
            own = places[first:first + n]
            out.append(_gather(ids, start[own], length[own]))
            first += n
        packed = pa.array([x.tobytes() for x in out], pa.binary())
        if parts:
            return pa.Table.from_batches(list(_parts(chunk.column("chunk")[0].as_py() << PART_BITS, docs, packed)))
        return pa.table({"id": docs, "n_tokens": pa.array([x.size for x in out], pa.int64()), "ids": packed})
    return run


def _encoded(docs: DataFrame, vocabulary: str, pattern: str, id_col: str, text_col: str, buckets: int, parts: bool) -> DataFrame:
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType
    chunks = src.mapInArrow(_chunks(pattern, to_arrow_type(kind)), f"chunk long, ids array<{kind.simpleString()}>, sizes array<long>, "
                            "places binary, words binary, word_sizes binary")
    # both readers take all columns, so one exchange serves them and texts are cut once
    chunks = chunks.repartition("chunk")
    met = (chunks.mapInArrow(_requests(buckets), "chunk long, bucket int, words binary, word_sizes binary")
           .repartition("bucket").sortWithinPartitions("bucket"))
    answers = met.mapInArrow(_answers(vocabulary), "chunk long, bucket int, ids binary, counts binary")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _together(buckets, parts), _parts_schema(kind) if parts else f"id {kind.simpleString()}, n_tokens long, ids binary")


def _parts_schema(kind: DataType) -> str:
    return f"chunk long, token int, docs array<{kind.simpleString()}>, ids array<binary>"


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(id, n_tokens, ids) of every row; ids are packed as little-endian
    unsigned 32 bits.  A task holds the distinct words of one bucket, some
    200 bytes each: give more ``buckets`` to a corpus of billions of them."""
    return _encoded(docs, vocabulary, pattern, id_col, text_col, buckets, False).withColumnRenamed("id", id_col)


def token_bytes(spark: SparkSession, vocabulary: str) -> DataFrame:
    """(token, bytes): the vocabulary as a table."""
    rows = sorted((i, bytearray(t)) for t, i in ranks_of(vocabulary).items())
    return spark.createDataFrame(rows, "token int, bytes binary")


def _parts(key: int, docs: pa.Array, ids: pa.Array):
    """Parts of some ``CHUNK_IDS`` tokens: of each one row with its documents
    (token -1) and one row per distinct token.  Returns the next key."""
    size = np.cumsum([0, *(len(x.as_buffer()) // 4 for x in ids)])
    first = 0
    while first < len(docs):
        last = max(first + 1, int(np.searchsorted(size, size[first] + CHUNK_IDS, "right")) - 1)
        own = ids.slice(first, last - first)
        found = np.unique(np.frombuffer(b"".join(own.to_pylist()), np.uint32)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.full(found.size + 1, len(x))]).astype(np.int32)), x)
                 for x in (docs.slice(first, last - first), own)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(found.size + 1, key)), pa.array(np.concatenate([[-1], found]).astype(np.int32)), *lists],
                                         names=["chunk", "token", "docs", "ids"])
        key, first = key + 1, last
    return key


def _distinct_ids(batches):
    """(id, ids) -> parts."""
    key = TaskContext.get().partitionId() << 32
    for b in batches:
        key = yield from _parts(key, b.column(0), b.column(1))


def _decoded(batches):
    """Rows sorted by chunk and token, the documents' row first."""
    docs, table = None, {}

    def chunk():
        ids = docs[1].to_pylist()
        texts, digests = [], []
        for x in ids:
            tokens = np.frombuffer(x, np.uint32).tolist()
            texts.append(b"".join(map(table.__getitem__, tokens)))
            digests.append(sha256(",".join(map(str, tokens)).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([docs[0], pa.array([len(x) // 4 for x in ids], pa.int64()), docs[1], pa.array(digests, pa.string()),
                                           pa.array(texts, pa.binary())], names=["id", "n_tokens", "ids", "ids_sha256", "decoded"])

    for b in batches:
        for r, (token, data) in enumerate(zip(b.column(1).to_pylist(), b.column(4).to_pylist())):
            if token == -1:
                if docs is not None:
                    yield chunk()
                docs, table = (b.column(2)[r].values, b.column(3)[r].values), {}
            else:
                table[token] = data or b""
    if docs is not None:
        yield chunk()


def _from_parts(asked: DataFrame, vocabulary: str, kind: DataType, id_col: str) -> DataFrame:
    found = asked.join(F.broadcast(token_bytes(asked.sparkSession, vocabulary)), "token", "left").select("chunk", "token", "docs", "ids", "bytes")
    out = found.sortWithinPartitions("chunk", "token").mapInArrow(
        _decoded, f"id {kind.simpleString()}, n_tokens long, ids binary, ids_sha256 string, decoded binary")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids, ids_sha256, decoded) of every row of (id, ids):
    the decoded bytes, and the hex digest of the decimal ids joined by commas
    (taken here, as a further Python step would be a further worker)."""
    src = encoded.select(F.col(id_col).alias("id"), F.col("ids"))
    kind = src.schema["id"].dataType
    return _from_parts(src.mapInArrow(_distinct_ids, _parts_schema(kind)), vocabulary, kind, id_col)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``decode(encode(docs))`` with one Python step less: the step that puts
    ids together hands on the parts that decoding starts from."""
    return _from_parts(_encoded(docs, vocabulary, pattern, id_col, text_col, buckets, True), vocabulary, docs.schema[id_col].dataType, id_col)
