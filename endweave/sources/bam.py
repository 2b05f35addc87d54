"""Binary alignments as a data source: files in blocks of compressed bytes, read in ranges and written in parts.

A file is cut into ranges of bytes. A task finds the first block in its range, and in what it inflates the
first record, by what the fields of several records in a row must be; it reads all records that start in
its blocks, into the next range where one ends there. Where it ends it looks for the next range's first
record as the task there does, and fails if that is not where its own last record ends. The first range
begins behind the header, so that all ranges hold exactly the file's records, or the read fails.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Records of a batch; bytes of a range; bytes of uncompressed data in a written block; records in a row
#: that a first record must be followed by.
BATCH, SPLIT, BLOCK, CHAIN = 20_000, 32 << 20, 0xFF00, 16
#: The empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_OPS = "MIDNSHP=X"
#: Sizes in bytes of the fixed-width types of tags.
_WIDTH = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_FORMAT = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
SCHEMA = "read_name string, flag int, chrom string, ref_start long, ref_end long, cigar string, nh int, file string"
_ARROW = pa.schema(
    [("read_name", pa.string()), ("flag", pa.int32()), ("chrom", pa.string()), ("ref_start", pa.int64()), ("ref_end", pa.int64()), ("cigar", pa.string()), ("nh", pa.int32()), ("file", pa.string())]
)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path names, and the path inside it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def block_size(head: bytes) -> int | None:
    """Bytes of the block that begins with these 18, None where none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04" or head[10:16] != b"\x06\x00BC\x02\x00":
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def block_at(file, start: int, length: int) -> int:
    """The first place from ``start`` on where a block begins, and another one or the end behind it."""
    at, held = start, b""
    while at < length:
        file.seek(at)
        held = file.read(1 << 17)
        i = held.find(b"\x1f\x8b\x08\x04")
        while 0 <= i:
            size = block_size(held[i : i + 18])
            if size is not None:
                file.seek(at + i + size)
                behind = file.read(18)
                if at + i + size == length or block_size(behind) is not None:
                    return at + i
            i = held.find(b"\x1f\x8b\x08\x04", i + 1)
        at += max(len(held) - 17, 1)
    return length


class Stream:
    """The uncompressed bytes of a file from a block on. ``at`` is the block that the next byte lies in."""

    def __init__(self, file, start: int, length: int, blocked: bool = True):
        self.file, self.next, self.length, self.blocked = file, start, length, blocked
        self.held, self.off = b"", 0
        #: (end of a block in ``held``, place of the block) of what is held.
        self.marks: list[tuple[int, int]] = []
        self.member = None

    def _more(self) -> bool:
        """Inflates one more block."""
        if self.next >= self.length:
            return False
        self.file.seek(self.next)
        if self.blocked:
            size = block_size(head := self.file.read(18))
            if size is None:
                raise ValueError(f"no block at byte {self.next}")
            rest = self.file.read(size - 18)
            if len(rest) < size - 18:
                raise ValueError("the file ends inside a block")
            place, data = self.next, zlib.decompressobj(wbits=31).decompress(head + rest)
            self.next += size
        else:
            place, data = self.next, self._member()
        self.held, self.marks = self.held[self.off :] + data, [(end - self.off, p) for end, p in self.marks if end > self.off]
        self.off = 0
        self.marks.append((len(self.held), place))
        return True

    def _member(self) -> bytes:
        """Some bytes of files of plain gzip members, which have no sizes in front."""
        if self.member is None:
            self.member = zlib.decompressobj(wbits=31)
        part = self.file.read(1 << 16)
        data = self.member.decompress(part)
        self.next += len(part)
        if self.member.eof:
            self.next -= len(self.member.unused_data)
            self.member = None
        elif self.next >= self.length:
            raise ValueError("the file ends inside a block")
        return data

    def take(self, n: int) -> bytes | None:
        """The next n bytes, None at the end."""
        while len(self.held) - self.off < n:
            if not self._more():
                if self.off < len(self.held):
                    raise ValueError("the file ends inside a record")
                return None
        out = self.held[self.off : self.off + n]
        self.off += n
        return out

    def peek(self, n: int, at: int) -> bytes:
        """Up to n bytes from the ``at``-th on, which stay."""
        while len(self.held) - self.off < at + n and self._more():
            pass
        return self.held[self.off + at : self.off + at + n]

    def number(self) -> int | None:
        four = self.take(4)
        return None if four is None else struct.unpack("<i", four)[0]

    def place(self) -> tuple[int, int]:
        """(block, offset in it) of the next byte; at the end (length, 0)."""
        while self.off == len(self.held):
            if not self._more():
                return self.length, 0
        start = 0
        for end, block in self.marks:
            if end > self.off:
                return block, self.off - start
            start = end
        return self.length, 0


def header(data: Stream) -> list[tuple[str, int]]:
    """(name, size) of the contigs; the stream is at the first record then."""
    if data.take(4) != b"BAM\x01":
        raise ValueError("not a binary alignment file")
    data.take(data.number())
    contigs = []
    for _ in range(data.number()):
        name = data.take(data.number())[:-1].decode()
        contigs.append((name, data.number()))
    return contigs


def plausible(data: Stream, at: int, sizes: list[int]) -> int | None:
    """Bytes of the record that may begin ``at`` bytes ahead, None if none does; 0 at the end of the file."""
    head = data.peek(36, at)
    if not head:
        return 0
    if len(head) < 36:
        return None
    size, contig, pos, name_size, _, _, n_ops, _, bases, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", head)
    if not (-1 <= contig < len(sizes) and -1 <= mate < len(sizes) and pos >= -1 and mate_pos >= -1 and name_size >= 1 and bases >= 0):
        return None
    if (contig >= 0 and pos > sizes[contig]) or (mate >= 0 and mate_pos > sizes[mate]):
        return None
    if size < 32 + name_size + 4 * n_ops + (bases + 1) // 2 + bases or size > 1 << 28:
        return None
    name = data.peek(name_size, at + 36)
    if len(name) < name_size or name[-1] != 0 or any(c < 33 or c > 126 for c in name[:-1]):
        return None
    ops = data.peek(4 * n_ops, at + 36 + name_size)
    if any(x & 15 >= len(_OPS) for x in struct.unpack(f"<{len(ops) // 4}I", ops)):
        return None
    return size + 4


def first_record(file, start: int, length: int, sizes: list[int]) -> tuple[int, int]:
    """(block, offset) of the first record that starts in a block at or behind ``start``."""
    block = block_at(file, start, length)
    if block >= length:
        return length, 0
    data, at = Stream(file, block, length), 0
    while data.peek(1, at):
        ahead = at
        for _ in range(CHAIN):
            size = plausible(data, ahead, sizes)
            if not size:
                break
            ahead += size
        if size is not None:
            data.off += at
            return data.place()
        at += 1
    return length, 0


def hits(tags: bytes) -> int | None:
    """The number of reported alignments (NH) among a record's tags."""
    at = 0
    while at + 3 <= len(tags):
        name, kind = tags[at : at + 2], chr(tags[at + 2])
        at += 3
        if kind in "ZH":
            at = tags.index(0, at) + 1
        elif kind == "B":
            width, n = _WIDTH[chr(tags[at])], struct.unpack_from("<i", tags, at + 1)[0]
            at += 5 + width * n
        else:
            if name == b"NH" and kind in _FORMAT:
                return struct.unpack_from(_FORMAT[kind], tags, at)[0]
            at += _WIDTH[kind]
    return None


def record(r: bytes, contigs: list[str]) -> tuple:
    """(read_name, flag, chrom, ref_start, ref_end, cigar, nh) of a record's bytes."""
    contig, pos, name_size, _, _, n_ops, flag, bases = struct.unpack_from("<iiBBHHHi", r)
    at = 32 + name_size
    tags = at + 4 * n_ops + (bases + 1) // 2 + bases
    cigar, span = unpacked(r[at : at + 4 * n_ops])
    return r[32 : at - 1].decode(), flag, contigs[contig] if contig >= 0 else "*", pos, pos + span, cigar, hits(r[tags:])


class Range(InputPartition):
    """Records that start in the blocks of [start, end) of a file; from ``first`` on where that is known."""

    def __init__(self, path: str, start: int, end: int, length: int, contigs: list[tuple[str, int]], first: tuple[int, int] | None, blocked: bool):
        self.path, self.start, self.end, self.length = path, start, end, length
        self.contigs, self.first, self.blocked = contigs, first, blocked


def ranged(path: str, split: int) -> list[Range]:
    """The ranges of a file; one without block sizes in front is one range."""
    system, inside = located(path)
    with system.open_input_file(inside) as file:
        length = file.size()
        blocked = block_size(file.read(18)) is not None
        data = Stream(file, 0, length, blocked)
        contigs = header(data)
        if not blocked:
            return [Range(path, 0, length, length, contigs, None, False)]
        first = data.place()
    starts = [first[0], *range((first[0] // split + 1) * split, length, split)]
    return [Range(path, a, b, length, contigs, first if a == first[0] else None, True) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def read_range(part: Range) -> Iterator[tuple]:
    system, inside = located(part.path)
    names, sizes = [n for n, _ in part.contigs], [s for _, s in part.contigs]
    with system.open_input_file(inside) as file:
        if not part.blocked:
            data = Stream(file, 0, part.length, False)
            header(data)
            while (size := data.number()) is not None:
                yield record(data.take(size), names)
            return
        block, offset = part.first or first_record(file, part.start, part.length, sizes)
        if block >= part.end:
            return
        data = Stream(file, block, part.length)
        data.take(offset)
        while (place := data.place())[0] < part.end:
            yield record(data.take(data.number()), names)
        if part.end < part.length and first_record(file, part.end, part.length, sizes) != place:
            raise ValueError(f"records of {part.path} can't be told apart at byte {part.end}; choose another split")


def files(path: str) -> list[fs.FileInfo]:
    """A file, or those of a folder but the hidden ones, by name."""
    system, inside = located(path)
    info = system.get_file_info(inside)
    if info.type != fs.FileType.Directory:
        return [info]
    found = system.get_file_info(fs.FileSelector(inside))
    return sorted((x for x in found if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))), key=lambda x: x.path)


def largest(path: str) -> int:
    """Bytes of the largest file."""
    return max((x.size or 0 for x in files(path)), default=0)


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))

    def partitions(self) -> list[Range]:
        system, _ = located(self.path)
        prefix = self.path.split("://")[0] + "://" if "://" in self.path and not isinstance(system, fs.LocalFileSystem) else ""
        return [r for x in files(self.path) for r in ranged(prefix + x.path, self.split)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        held = []
        for row in read_range(part):
            held.append((*row, part.path.rpartition("/")[2]))
            if len(held) == BATCH:
                yield batch(held)
                held = []
        if held:
            yield batch(held)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def block(data: bytes) -> bytes:
    packed = zlib.compressobj(wbits=-15)
    body = packed.compress(data) + packed.flush()
    size = struct.pack("<H", len(body) + 25)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + size + body + struct.pack("<II", zlib.crc32(data), len(data))


def encoded(batch: pa.RecordBatch, contigs: dict[str, int]) -> Iterator[bytes]:
    """Records without bases. Columns as they are read; a contig that is not named is an error."""
    columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("read_name", "flag", "chrom", "ref_start", "cigar", "nh")]
    for name, flag, chrom, start, cigar, nh in zip(*columns, strict=True):
        ops, name = packed(cigar), (name or "*").encode() + b"\0"
        contig = -1 if chrom in (None, "*") else contigs[chrom]
        tags = b"" if nh is None else b"NHi" + struct.pack("<i", nh)
        yield _FIXED.pack(32 + len(name) + len(ops) + len(tags), contig, start, len(name), 255, 4680, len(ops) // 4, flag, 0, -1, -1, 0) + name + ops + tags


#: Size and fixed fields of a record.
_FIXED = struct.Struct("<iiiBBHHHiiii")


@lru_cache(maxsize=1 << 14)
def packed(cigar: str | None) -> bytes:
    """The operations of a CIGAR string as a record has them; most reads share theirs with others."""
    ops = [] if cigar in (None, "*") else [int(n) << 4 | _OPS.index(k) for n, k in _cut(cigar)]
    return struct.pack(f"<{len(ops)}I", *ops)


@lru_cache(maxsize=1 << 14)
def unpacked(ops: bytes) -> tuple[str, int]:
    """(CIGAR string, positions that it spans) of a record's operations."""
    found = struct.unpack(f"<{len(ops) // 4}I", ops)
    return "".join(f"{x >> 4}{_OPS[x & 15]}" for x in found) or "*", sum(x >> 4 for x in found if _OPS[x & 15] in "MDN=X")


def _cut(cigar: str) -> Iterator[tuple[str, str]]:
    digits = ""
    for c in cigar:
        if c.isdigit():
            digits += c
        else:
            yield digits, c
            digits = ""


class BamWriter(DataSourceArrowWriter):
    """A file for each task, under a hidden name until the job commits."""

    def __init__(self, options: dict):
        self.path, self.contigs = options["path"], [tuple(c) for c in json.loads(options["contigs"])]

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, inside = located(self.path)
        system.create_dir(inside, recursive=True)
        hidden = f"{inside}/_{uuid.uuid4().hex}"
        text = b"@HD\tVN:1.6\n"
        held = b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.contigs))
        for name, size in self.contigs:
            held += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
        numbers = {name: i for i, (name, _) in enumerate(self.contigs)}
        with system.open_output_stream(hidden) as out:
            parts = [held]
            size = len(held)
            for found in (r for b in batches for r in encoded(b, numbers)):
                parts.append(found)
                size += len(parts[-1])
                while size >= BLOCK:
                    whole = b"".join(parts)
                    out.write(block(whole[:BLOCK]))
                    parts, size = [whole[BLOCK:]], size - BLOCK
            out.write(block(b"".join(parts)))
            out.write(END)
        return Written(hidden)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, inside = located(self.path)
        for i, m in enumerate(m for m in messages if m is not None):
            system.move(m.file, f"{inside}/part-{i:05d}.bam")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = located(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(m.file)


class Written(WriterCommitMessage):
    def __init__(self, file: str):
        self.file = file


class BamSource(DataSource):
    """Format ``bam``. Reading: a file or a folder; option ``split``, bytes of a range. Writing: the columns
    that are read; option ``contigs``, a JSON list of [name, size]."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)
