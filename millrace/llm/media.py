"""Media columns: content-addressed payloads in tar shards.

A payload is stored as an 8-bit grey PNG image, 64 samples a line, losslessly. Each writing task owns
one tar shard; a member's name is the SHA-256 of its payload, and a task stores equal payloads once.
Rows carry the digest, the shard, and the member's offset and length there, never the bytes. Metadata
columns come from range reads of the members' first bytes alone.

Shards and index appear atomically, under the names of their input partitions, so a task that is run
again replaces nothing that others read.

Defined results: null text counts as empty; an empty payload is padded to 64 bytes; equal texts have
equal values; repeated rows share a member; a text of any length is one member; a null key stays null; columns
other than the key and the text are left out, so none can clash; an empty table gives an empty index; a
member that was changed is found by its digest. A task holds a digest and a place for each distinct
payload of its partition until its shard is closed, as rows may only name a shard that exists.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.common import AtomicFile, filesystem, scratch, slices, stash, texts

LINE = 64
#: Fixed values of the PNG format: signature, and the header's length and name.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
IHDR = b"\x00\x00\x00\rIHDR"
HEADER = len(SIGNATURE) + 25
SHUT = struct.pack(">I", 0) + b"IEND" + struct.pack(">I", zlib.crc32(b"IEND"))


def pad(data: bytes) -> bytes:
    """data and zeros up to a positive multiple of LINE."""
    return data + bytes(max(LINE, -(-len(data) // LINE) * LINE) - len(data))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """An 8-bit grey image of the payload's bytes; no line filter."""
    lines = np.frombuffer(payload, np.uint8).reshape(-1, LINE)
    raw = np.zeros((len(lines), LINE + 1), np.uint8)
    raw[:, 1:] = lines
    head = struct.pack(">IIBBBBB", LINE, len(lines), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), 3)) + SHUT


def png_size(head: bytes) -> tuple[int, int]:
    """Width and height, from the first bytes alone."""
    if head[:8] != SIGNATURE or head[8:16] != IHDR:
        raise ValueError("not a PNG image")
    return struct.unpack(">II", head[16:24])


def from_png(image: bytes) -> bytes:
    """The samples of an image that to_png made; chunks' checksums are verified."""
    width, height = png_size(image)
    at, data = 8, []
    while at < len(image):
        (n,) = struct.unpack_from(">I", image, at)
        kind, body = image[at + 4 : at + 8], image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError("a damaged chunk")
        if kind == b"IDAT":
            data.append(body)
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if raw[:, 0].any():
        raise ValueError("a filtered line")
    return raw[:, 1:].tobytes()


def store(df: DataFrame, key: str, column: str, folder: str | None = None) -> DataFrame:
    """Write the payloads of a text column; returns key, n_bytes, digest, shard, offset and length."""
    folder = folder or scratch(df.sparkSession, "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/shard-{TaskContext.get().partitionId():06d}.tar"
        where: dict[bytes, tuple[int, int]] = {}
        rows = []
        with AtomicFile(name) as out:
            at = 0
            for batch in slices(batches, column):
                n, digests, places = [], [], []
                for text in texts(batch, column):
                    data = text.encode("utf-8", "surrogatepass")
                    payload = pad(data)
                    digest = hashlib.sha256(payload).digest()
                    if digest not in where:
                        image = to_png(payload)
                        info = tarfile.TarInfo(digest.hex() + ".png")
                        info.size = len(image)
                        head = info.tobuf(tarfile.USTAR_FORMAT)
                        out.write(head + image + bytes(-len(image) % tarfile.BLOCKSIZE))
                        where[digest] = at + len(head), len(image)
                        at += len(head) + -(-len(image) // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
                    n.append(len(data))
                    digests.append(digest.hex())
                    places.append(where[digest])
                rows.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests), pa.array([name] * len(n)), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())], names=["key", "n_bytes", "digest", "shard", "offset", "length"]))
            out.write(bytes(2 * tarfile.BLOCKSIZE))
        yield from rows

    kind = df.schema[key].dataType.simpleString()
    stored = df.select(key, column).mapInArrow(run, f"key {kind}, n_bytes long, digest string, shard string, offset long, length long")
    return stash(stored.withColumnRenamed("key", key), "mediaindex")


def _ranges(batches: Iterator[pa.RecordBatch], size: int | None) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[int, bytes]]]]:
    """Batches of an index and, for the first row of each member in turn, the bytes asked for."""
    for batch in batches:
        shards = batch.column(batch.schema.get_field_index("shard")).to_pylist()
        offsets = batch.column(batch.schema.get_field_index("offset")).to_pylist()
        lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
        opened: dict = {}

        def read(shards=shards, offsets=offsets, lengths=lengths, opened=opened):
            for k, (shard, offset, length) in enumerate(zip(shards, offsets, lengths)):
                if shard not in opened:
                    fs, path = filesystem(shard)
                    opened[shard] = fs.open_input_file(path)
                yield k, opened[shard].read_at(length if size is None else min(size, length), offset)

        yield batch, read()
        for f in opened.values():
            f.close()


def metadata(index: DataFrame) -> DataFrame:
    """index with `width` and `height`, from reads of the members' headers alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, heads in _ranges(batches, HEADER):
            sizes = [png_size(h) for _, h in heads]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s[0] for s in sizes], pa.int64()), pa.array([s[1] for s in sizes], pa.int64())], names=[*batch.schema.names, "width", "height"])

    return index.mapInArrow(run, f"{index._jdf.schema().toDDL()}, width long, height long")


def features(index: DataFrame) -> DataFrame:
    """index with what the stored bytes themselves give: sizes, digests, checksum and a feature string.

    The feature holds the image's width and height, those of metadata's columns where index has them, and
    the samples' mean and deviation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, images in _ranges(batches, None):
            seen: dict[str, tuple] = {}
            digests = batch.column(batch.schema.get_field_index("digest")).to_pylist()
            heads = list(zip(*(batch.column(c).to_pylist() for c in ("width", "height")))) if "width" in batch.schema.names else None
            rows = []
            for k, image in images:
                if digests[k] not in seen:
                    payload = from_png(image)
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest != digests[k]:
                        raise ValueError(f"member {digests[k]} holds other bytes")
                    width, height = heads[k] if heads else png_size(image[:HEADER])
                    samples = np.frombuffer(payload, np.uint8)
                    feature = f"png:{width}x{height}:mean={samples.mean():.3f}:dev={samples.std():.3f}"
                    seen[digests[k]] = (len(payload), digest, zlib.crc32(payload[-LINE:]), len(image), hashlib.sha256(image).hexdigest(), feature)
                rows.append(seen[digests[k]])
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            new = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *NEW])

    kinds = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return index.mapInArrow(run, f"{index._jdf.schema().toDDL()}, {kinds}")


NEW = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def members(shard: bytes) -> dict[str, bytes]:
    """All members of a shard, through the standard library."""
    with tarfile.open(fileobj=io.BytesIO(shard)) as t:
        return {m.name: t.extractfile(m).read() for m in t}
