"""Byte-level BPE over a corpus: every distinct word is encoded once.

1. Split. Tasks cut texts into pre-tokens and collect blocks of documents. A block holds its distinct
   words, packed by hash range, and every document as positions in that list.
2. Encode. The packed words are shuffled by range: all copies of a word meet in one group, which
   merges them, encodes each distinct word once and sends the ids back per block. The number of
   ranges grows with the blocks, so a group's size does not.
3. Reassemble. Ids and documents meet by block; ids are put at their words' positions, and decoding
   joins them with the table of token bytes.

A block is bounded by its text size (one longer text is a block of its own), so no key, source or
frequent word makes a group grow: a word counts once per block. What moves is the packed words and
positions, never the texts.

Null text counts as empty. Empty texts give zero tokens and the digest of nothing. Repeated rows are
encoded each; a null ``doc_id`` stays null. Other columns are not read.
"""

import base64
import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard

from pyspark.sql import functions as F

from portledger.llm.common import partitions, stored

# Text characters per block.
BLOCK_CHARS = 24 << 20
# Documents' positions are packed together up to so many tokens.
PACK_TOKENS = 1 << 20
LONG_TEXT = 4 << 20

PACKED = "block long, part int, doc_ids array<long>, counts binary, data binary"
ENCODED = "doc_id long, ids binary, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ORDER, DOCUMENTS = -2, -1


def default_vocabulary():
    """Ranks file and split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def read_ranks(path):
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _pack(array):
    """Integers as compressed byte planes."""
    a = np.ascontiguousarray(array, dtype="<u4")
    return zstandard.compress(a.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(data):
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _pack_places(places, once):
    """Word places as byte planes. Small ones take a byte, others 20 bits. The words from ``once`` on occur once in
    the block and are numbered as they occur, so a mark is enough for them."""
    a = np.asarray(places, np.int64)
    single = a >= once
    high = (a - 192) >> 12
    middle = ~single & (a >= 192) & (high < 62)
    rare = ~single & (high >= 62)
    first = np.where(single, 255, np.where(rare, 254, np.where(middle, 192 + high, a))).astype(np.uint8)
    rest = (a[middle] - 192) & 4095
    nibbles = np.append(rest & 15, 0)[: len(rest) + len(rest) % 2].astype(np.uint8)
    head = np.array([len(a), len(rest), a[single][0] if single.any() else 0], "<u4")
    parts = [head, first, (rest >> 4).astype(np.uint8), nibbles[0::2] | nibbles[1::2] << 4, a[rare].astype("<u4")]
    return zstandard.compress(b"".join(p.tobytes() for p in parts), 9)


def _unpack_places(data):
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size, rest, single = raw[:12].view("<u4").tolist()
    first = raw[12 : 12 + size].astype(np.int64)
    at = 12 + size
    upper = raw[at : at + rest].astype(np.int64)
    packed = raw[at + rest : at + rest + (rest + 1) // 2]
    lower = np.stack([packed & 15, packed >> 4], axis=1).ravel()[:rest]
    out = first.copy()
    middle = (first >= 192) & (first < 254)
    out[middle] = ((first[middle] - 192) << 12) + (upper << 4 | lower) + 192
    marked = first == 255
    out[marked] = single + np.arange(marked.sum())
    out[first == 254] = np.frombuffer(raw[at + rest + (rest + 1) // 2 :].tobytes(), "<u4")
    return out


class _Places(dict):
    def __missing__(self, word):
        self[word] = place = len(self)
        return place


class _Block:
    """Words and documents of one block."""

    def __init__(self):
        self.words, self.docs, self.chars = _Places(), [], 0

    def add(self, doc_id, text, pattern):
        self.chars += len(text) + 64
        place = self.words.__getitem__
        if len(text) <= LONG_TEXT:
            found = list(map(place, pattern.findall(text)))
        else:
            found = (place(m[0]) for m in pattern.finditer(text))
        self.docs.append((doc_id, np.fromiter(found, np.uint32)))

    def rows(self, ranges, number):
        words = list(self.words)
        used = np.concatenate([d for _, d in self.docs]) if self.docs else np.empty(0, np.uint32)
        # Frequent words get small numbers, which pack well.
        rank = np.empty(len(words), np.uint32)
        times = np.bincount(used, minlength=len(words))
        rank[np.argsort(-times, kind="stable")] = np.arange(len(words))
        once = int((times > 1).sum())
        raw = [w.encode() for w in words]
        where = sorted(range(len(words)), key=lambda i: (zlib.crc32(raw[i]) % ranges, raw[i]))
        yield number, ORDER, [], b"", _pack(rank[where])
        for part, group in itertools.groupby(where, key=lambda i: zlib.crc32(raw[i]) % ranges):
            own = [raw[i] for i in group]
            yield number, part, [], _pack([len(w) for w in own]), zstandard.compress(b"".join(own), 9)
        ids, parts, size = [], [], 0
        for doc_id, found in self.docs:
            ids.append(doc_id)
            parts.append(rank[found])
            size += len(found)
            if size >= PACK_TOKENS:
                yield number, DOCUMENTS, ids, _pack([len(p) for p in parts]), _pack_places(np.concatenate(parts), once)
                ids, parts, size = [], [], 0
        if ids:
            yield number, DOCUMENTS, ids, _pack([len(p) for p in parts]), _pack_places(np.concatenate(parts), once)


PACKED_ARROW = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("data", pa.binary())]
)


def _splitter(split_pattern, ranges, block_chars):
    def split(batches):
        from pyspark import TaskContext

        pattern = regex.compile(split_pattern)
        task, made = TaskContext.get().partitionId(), 0
        block = _Block()

        def flush():
            columns = list(zip(*block.rows(ranges, (task << 32) + made)))
            table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED_ARROW)], schema=PACKED_ARROW)
            return table.to_batches(max_chunksize=64)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block.docs and block.chars + len(text) > block_chars:
                    yield from flush()
                    made, block = made + 1, _Block()
                block.add(doc_id, text, pattern)
        if block.docs:
            yield from flush()

    return split


def _encoder(ranks_path, split_pattern):
    def encode(table):
        """All blocks' words of one range: each distinct word is encoded once."""
        own = tiktoken.Encoding("ranks", pat_str=split_pattern, mergeable_ranks=_ranks(ranks_path), special_tokens={})
        known = {}
        rows = []
        for block, part, counts, data in zip(*(table.column(c).to_pylist() for c in ("block", "part", "counts", "data"))):
            raw, lengths, sizes = zstandard.decompress(data), _unpack(counts), []
            flat, at = [], 0
            for n in lengths.tolist():
                word = raw[at : at + n]
                at += n
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = own.encode_ordinary(word.decode())
                sizes.append(len(ids))
                flat += ids
            rows.append((block, part, [], _pack(sizes), _pack(flat)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED_ARROW)], schema=PACKED_ARROW)

    return encode


_RANKS = {}


def _ranks(path):
    if path not in _RANKS:
        _RANKS[path] = read_ranks(path)
    return _RANKS[path]


def _token_bytes(path):
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return pa.array(table, pa.binary())


def _assembled(table):
    """``(doc_ids, token counts, ids)`` of every pack of documents of a block."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("part", "doc_ids", "counts", "data"))))
    order = next(_unpack(d) for p, _, _, d in rows if p == ORDER)
    encoded = sorted((p, c, d) for p, _, c, d in rows if p >= 0)
    empty = np.empty(0, np.int64)
    sizes = np.concatenate([empty, *(_unpack(c) for _, c, _ in encoded)])
    flat = np.concatenate([empty, *(_unpack(d) for _, _, d in encoded)])
    if len(sizes) != len(order):
        raise ValueError("a block's words and ids differ: its input changed between reads")
    begin = np.concatenate([empty, np.cumsum(sizes) - sizes])
    by_rank = np.empty(len(order), np.int64)
    by_rank[order] = np.arange(len(order))
    sizes, begin = sizes[by_rank], begin[by_rank]
    for part, doc_ids, counts, data in rows:
        if part != DOCUMENTS:
            continue
        words, lengths = _unpack_places(data), _unpack(counts)
        n = sizes[words]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begin[words] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
        yield doc_ids, upto, ids


def _taken(values, ids):
    """Bytes of ``values`` at ``ids``, end to end, and the end of each."""
    found = values.take(pa.array(ids))
    ends = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1, offset=4 * found.offset)
    return (found.buffers()[2] or b""), ends


def _each_document(table, ranks_path):
    """``(doc_id, ids, ids as text, decoded bytes)`` of a block's documents."""
    token_bytes = _token_bytes(ranks_path)
    decimal = pa.array([f" {i}".encode() for i in range(len(token_bytes))], pa.binary())
    for doc_ids, upto, ids in _assembled(table):
        text, text_ends = _taken(decimal, ids)
        raw, raw_ends = _taken(token_bytes, ids)
        text, raw = memoryview(text), memoryview(raw)
        for doc_id, a, b in zip(doc_ids, upto[:-1].tolist(), upto[1:].tolist()):
            yield doc_id, ids[a:b], text[text_ends[a] + (b > a) : text_ends[b]], raw[raw_ends[a] : raw_ends[b]]


def _digester(ranks_path):
    def digest(table):
        rows = [
            (d, len(i), hashlib.sha256(t).hexdigest(), hashlib.sha256(r).hexdigest())
            for d, i, t, r in _each_document(table, ranks_path)
        ]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digest


def _full(ranks_path):
    def full(table):
        rows = [(d, i.astype("<u4").tobytes(), bytes(r)) for d, i, _, r in _each_document(table, ranks_path)]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
            names=["doc_id", "ids", "decoded"],
        )

    return full


def packed_blocks(docs, split_pattern, block_chars=BLOCK_CHARS):
    """Step 1, written to the shared folder."""
    spark = docs.sparkSession
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text)
    ranges = max(partitions(spark), rows.rdd.getNumPartitions())
    return stored(rows.mapInArrow(_splitter(split_pattern, ranges, block_chars), PACKED), "bpe")


def _blocks(docs, ranks_path, split_pattern, block_chars):
    if ranks_path is None:
        ranks_path, split_pattern = default_vocabulary()
    packed = packed_blocks(docs, split_pattern, block_chars)
    words = packed.where("part >= 0")
    ids = words.groupBy("part").applyInArrow(_encoder(ranks_path, split_pattern), PACKED)
    return packed.where("part < 0").unionByName(ids).groupBy("block"), ranks_path


def encode_documents(docs, ranks_path=None, split_pattern=None, block_chars=BLOCK_CHARS):
    """``(doc_id, ids, decoded)``: ids as little-endian 32-bit integers, and the bytes they decode to."""
    blocks, ranks_path = _blocks(docs, ranks_path, split_pattern, block_chars)
    return blocks.applyInArrow(_full(ranks_path), ENCODED)


def document_digests(docs, ranks_path=None, split_pattern=None, block_chars=BLOCK_CHARS):
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every document."""
    blocks, ranks_path = _blocks(docs, ranks_path, split_pattern, block_chars)
    return blocks.applyInArrow(_digester(ranks_path), DIGESTS)


def op4_byte_bpe(spark, sf_dir):
    return document_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
