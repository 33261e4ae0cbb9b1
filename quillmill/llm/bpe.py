"""BPE encoding and decoding with content-defined chunk reuse.

Every text is cut by a rolling hash into chunks, so that texts which share a long passage
share its inner chunks wherever the passage stands.  A cut moves on to the next border between
words, marks, numbers or white space at which every encoding has a token border, so that texts
without spaces are cut, too; a run without such a border stays in one chunk.  Chunks are keyed
by content and meet in one shuffle; each distinct chunk is encoded once (a chunk with over
SPLIT_USES uses in a map task, once for so many).  Texts that are a single chunk get their
digests there.  The ids of the other chunks travel to their texts, where each joint between
two chunks is repaired: the tokens around the joint are decoded, encoded again as one string
and spliced in, and the window grows until the outer tokens of the new encoding agree exactly
with what both sides had.  The windows are as small as the distance to a few borders, so the
time is linear in the text.

Sizes: texts travel once (compressed per chunk); copies of a text that a map task meets within
FLUSH_BYTES travel as one, other copies by their chunks, which are encoded once all the same.
Ids travel at most once per map task that has the text (16 bits each, compressed).  A Python
worker holds at most FLUSH_BYTES of chunks and uses, MAX_SEEN uses, and one text.
"""

from __future__ import annotations

import hashlib
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import table, text_or_empty

#: Chunk sizes in bytes: at least, on average beyond that, at most.
MIN_CHUNK, AVG_CHUNK, MAX_CHUNK = 1024, 4096, 16384
#: Bytes the rolling hash looks back.
WINDOW = 48
#: Raw bytes of chunks that a map task holds before it hands them on.
FLUSH_BYTES = 32 << 20
#: Uses of one chunk in a row of the shuffle; and uses that an encoding task remembers so as not to send them twice.
SPLIT_USES, MAX_SEEN = 4096, 200_000
#: Compression of what is shuffled.
LEVEL = 6
#: Tokens on each side of a joint that are encoded again at first.
FIRST_WINDOW = 8

_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_BLOCK = 1 << 20


def _byte_values() -> np.ndarray:
    return np.frombuffer(hashlib.shake_256(b"chunk bytes").digest(256 * 8), dtype="<u8").copy()


_VALUES = _byte_values()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = tuple(np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(size - 1, p, "u8")])) for p in (_P, _P_INV))
    return _POWERS[size]


def _candidates(data: bytes) -> np.ndarray:
    """Offsets after which the polynomial hash of the last WINDOW bytes selects a cut."""
    found = []
    for at in range(0, len(data), _BLOCK):
        start = max(0, at - WINDOW)
        part = np.frombuffer(data, "u1", min(len(data), at + _BLOCK) - start, start)
        power, inverse = _powers(len(part))
        total = np.cumsum(_VALUES[part] * inverse[: len(part)])
        rolled = total.copy()
        rolled[WINDOW:] -= total[:-WINDOW]
        rolled *= power[: len(part)]
        hit = np.flatnonzero((rolled >> np.uint64(40)) % np.uint64(AVG_CHUNK) == 0) + start + 1
        found.append(hit[hit > at])
    return np.concatenate(found) if found else np.zeros(0, "i8")


class _Kinds(dict):
    """character -> kind: letter, number, space or other mark; empty where the versions of
    Unicode that libraries use may differ."""

    def __missing__(self, c: str) -> str:
        now, old = unicodedata.category(c), unicodedata.ucd_3_2_0.category(c)
        if c in "\t\n\v\f\r" or now[0] == "Z" == old[0]:
            kind = "S"
        elif now != old or now[0] in "CZ" or "\x1c" <= c <= "\x1f":
            kind = ""
        else:
            kind = now[0] if now[0] in "LN" else "O"
        self[c] = kind
        return kind


_KINDS = _Kinds()


def is_border(a: str, b: str) -> bool:
    """Whether every encoding has a token border between the neighbours ``a`` and ``b``.

    The pre-tokeniser's runs hold characters of one kind, with a space before them or an
    apostrophe before some letters; so nothing spans a change of kind but those two.
    """
    x, y = _KINDS[a], _KINDS[b]
    return x != y and x != "" and y != "" and x != "S" and not (a == "'" and y == "L")


def _next_border(data: bytes, at: int, specials: tuple[bytes, ...] = ()) -> int:
    """The first border at or after the offset ``at`` that is not inside a special string, else
    the end."""
    n = len(data)
    start = at
    while start > 0 and at - start < 4:
        start -= 1
        if data[start] & 0xC0 != 0x80:
            break
    step = 256
    while start < n:
        end = min(n, start + step)
        while end < n and data[end] & 0xC0 == 0x80:
            end += 1
        text = data[start:end].decode()
        offset = start
        for a, b in zip(text, text[1:], strict=False):
            offset += len(a.encode())
            if offset >= at and is_border(a, b) and not any(data.find(x, max(0, offset - len(x) + 1), offset + len(x) - 1) >= 0 for x in specials):
                return offset
        if end == n:
            break
        start, step = offset, 2 * step
    return n


def chunks(data: bytes, specials: tuple[bytes, ...] = ()) -> list[bytes]:
    """Content-defined chunks of UTF-8 bytes, cut at borders and never inside one of
    ``specials``.  ``b""`` is one chunk."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [data]
    out, start = [], 0
    cuts = _candidates(data).tolist()
    i = 0
    while n - start > MIN_CHUNK:
        while i < len(cuts) and cuts[i] < start + MIN_CHUNK:
            i += 1
        end = min(cuts[i] if i < len(cuts) else n, start + MAX_CHUNK, n)
        if end < n:
            while data[end] & 0xC0 == 0x80:
                end -= 1
            end = _next_border(data, end, specials)
        out.append(data[start:end])
        start = end
    if start < n:
        out.append(data[start:])
    return out


class Codec:
    """Encodes exactly as the tokenizers library does with the file at ``path``."""

    def __init__(self, path: str):
        import json
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(printable))}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in spec["model"]["vocab"].items() if all(c in byte_of for c in w)}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {w: i for w, i in ranks.items() if i not in special.values()}
        self.bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for w, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.bytes[i] = w
        self.lengths = [len(x) for x in self.bytes]
        # The quick encoder has the same merges; it is used for texts in plain characters on which both libraries' character classes agree.
        self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = list(special)
        self.odd = re.compile("[^\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]")

    def encode(self, text: str) -> list[int]:
        if self.odd.search(text) or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; invalid bytes become U+FFFD."""
        out = b"".join(map(self.bytes.__getitem__, ids))
        return out.decode("utf-8", "replace").encode()

    def _borders(self, ids: list[int]) -> list[int]:
        """The token indexes inside ``ids`` at which every encoding of any surrounding text has
        a token border."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        first = 0
        while first < len(data) and data[first] & 0xC0 == 0x80:
            first += 1
        text = data[first:].decode("utf-8", "ignore")
        found, offset = set(), first
        for a, b in zip(text, text[1:], strict=False):
            offset += len(a.encode())
            if is_border(a, b):
                found.add(offset)
        out, at = [], 0
        for k, i in enumerate(ids):
            if at in found:
                out.append(k)
            at += self.lengths[i]
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' text, from their encodings; ``left`` is changed in place."""
        k, outer = FIRST_WINDOW, 1
        while True:
            head, tail = left[-k:], right[:k]
            n = len(head)
            found = self._borders(head + tail)
            before, after = [x for x in found if x < n], [x - n for x in found if x > n]
            all_left, all_right = k >= len(left), k >= len(right)
            if (len(before) <= outer and not all_left) or (len(after) <= outer and not all_right):
                k *= 2
                continue
            # The window ends at borders; the tokens up to the nearest ones must come out again.
            a, a2 = (before[-outer - 1], before[-1]) if len(before) > outer else (0, 0)
            z, z2 = (after[outer], after[0]) if len(after) > outer else (len(tail), len(tail))
            whole = len(before) <= outer and len(after) <= outer
            new = self.encode(b"".join(map(self.bytes.__getitem__, head[a:] + tail[:z])).decode("utf-8"))
            same = new[: a2 - a] == head[a:a2] and (z == z2 or new[len(new) - (z - z2) :] == tail[z2:z])
            if same or whole:
                del left[len(left) - n + a :]
                left += new
                left += right[z:]
                return left
            outer += 1


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _digests(c: Codec, ids: list[int]) -> tuple[int, bytes, bytes]:
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).digest(), hashlib.sha256(c.decode(ids)).digest()


_CHUNK_SCHEMA = "h binary, part int, data binary, uses binary"
_PIECE_SCHEMA = "text_key binary, pos int, n int, ids binary, n_tokens long, ids_sha256 binary, decoded_sha256 binary"
_USE = "<16sII"


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        specials = tuple(x.encode() for x in codec(path).special)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        held: dict[bytes, tuple[bytes, bytearray]] = {}
        keys: set[bytes] = set()
        size = 0
        most = SPLIT_USES * struct.calcsize(_USE)

        def flush():
            rows = ((h, at // most, data, bytes(uses[at : at + most])) for h, (data, uses) in held.items() for at in range(0, len(uses), most))
            part, n = [], 0
            for row in rows:
                part.append(row)
                n += len(row[2]) + len(row[3])
                if len(part) >= 500 or n >= 4 << 20:
                    yield batch_of(part)
                    part, n = [], 0
            if part:
                yield batch_of(part)
            held.clear()
            keys.clear()

        def batch_of(part):
            columns = zip(*part, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["h", "part", "data", "uses"])

        for batch in batches:
            for text in batch.column(0):
                data = (text.as_py() or "").encode()
                key = hashlib.md5(data, usedforsecurity=False).digest()
                if key in keys:
                    continue
                keys.add(key)
                parts = chunks(data, specials)
                for pos, part in enumerate(parts):
                    h = hashlib.blake2b(part, digest_size=16).digest() if len(parts) > 1 else key
                    if h not in held:
                        held[h] = (squeeze.compress(part), bytearray())
                        size += len(part)
                    held[h][1].extend(struct.pack(_USE, key, pos, len(parts)))
                    size += struct.calcsize(_USE)
                if size >= FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
    names = ["text_key", "pos", "n", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by chunk, so each chunk of the partition is encoded once."""
        import zstandard

        c, squeeze, expand = codec(path), zstandard.ZstdCompressor(level=LEVEL, write_checksum=False), zstandard.ZstdDecompressor()
        last, ids, packed, digests, seen = None, [], b"", None, set()
        rows: list[tuple] = []
        for batch in batches:
            for h, _, data, uses in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if h != last:
                    last, packed, digests, seen = h, b"", None, set()
                    ids = c.encode(expand.decompress(data).decode())
                for use in struct.iter_unpack(_USE, uses):
                    if use in seen:
                        continue
                    if len(seen) >= MAX_SEEN:
                        seen.clear()
                    seen.add(use)
                    if use[2] == 1:
                        digests = digests or _digests(c, ids)
                        rows.append((*use, None, *digests))
                    else:
                        packed = packed or squeeze.compress(np.array(ids, "<u2" if len(c.bytes) <= 65536 else "<u4").tobytes())
                        rows.append((*use, packed, None, None, None))
                    if len(rows) >= 500:
                        yield _rows(rows)
                        rows = []
        if rows:
            yield _rows(rows)

    return run


def _assemble(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by text and position; the same piece may come from several tasks."""
        import zstandard

        c, expand = codec(path), zstandard.ZstdDecompressor()
        kind = "<u2" if len(c.bytes) <= 65536 else "<u4"
        key, pos, ids = None, -1, []
        rows: list[tuple] = []
        for batch in batches:
            for k, p, n, packed, *digests in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if k != key:
                    key, pos, ids = k, -1, []
                if p == pos:
                    continue
                pos = p
                if n == 1:
                    rows.append((k, 0, 1, None, *digests))
                else:
                    part = np.frombuffer(expand.decompress(packed), kind).tolist()
                    ids = c.join(ids, part) if p else part
                    if p == n - 1:
                        rows.append((k, 0, n, None, *_digests(c, ids)))
                if len(rows) >= 1000:
                    yield _rows(rows)
                    rows = []
        if rows:
            yield _rows(rows)

    return run


def encode_texts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with n_tokens, ids_sha256, decoded_sha256 and n_chunks for its column ``text``.

    Null and empty texts have no tokens and the digests of nothing; repeated rows stay as many
    as they are; an empty table gives an empty result.  Columns of ``df`` stay as they are;
    those of the same name as a new one are replaced.
    """
    texts = df.select(text_or_empty(F.col(text)).alias("text"))
    pieces = (
        texts.mapInArrow(_cut(path), _CHUNK_SCHEMA)
        .repartition("h", "part").sortWithinPartitions("h")
        .mapInArrow(_encode(path), _PIECE_SCHEMA)
    )
    done = pieces.repartition("text_key").sortWithinPartitions("text_key", "pos").mapInArrow(_assemble(path), _PIECE_SCHEMA)
    done = done.select(F.col("text_key").alias("__key"), "n_tokens", "ids_sha256", "decoded_sha256", F.col("n").cast("long").alias("n_chunks"))
    out = ["n_tokens", "ids_sha256", "decoded_sha256", "n_chunks"]
    keyed = df.select(*(c for c in df.columns if c not in out), F.unhex(F.md5(text_or_empty(F.col(text)).cast("binary"))).alias("__key"))
    joined = keyed.join(done, "__key", "left").drop("__key")
    return joined.withColumns({c: F.lower(F.hex(c)) for c in ("ids_sha256", "decoded_sha256")})


def encode_ids(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) for each row: the plain per-text form, for consumers of the ids."""

    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.encode(x or "") for x in b.column(1).to_pylist()], pa.list_(pa.int32()))], names=["key", "ids"])

    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {dict(df.dtypes)[key]}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) for each row of ids; null ids give the empty text."""

    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []).decode() for x in b.column(1).to_pylist()], pa.string())], names=["key", "text"])

    return df.select(F.col(key).alias("key"), F.col(ids)).mapInArrow(run, f"key {dict(df.dtypes)[key]}, text string").withColumnRenamed("key", key)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ids and decoded text for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chunks")


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with their token counts and digests."""
    return encode_texts(docs, tokenizer_path())
