"""Alignment records of BAM files (the published binary form of SAM), one task a file, streamed.

Files are listed by Spark and opened by Arrow's file systems, so a folder that all machines see is needed. A file is unpacked
block by block; a task holds one block and the batch it gives out, whatever the file's size.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from seqloom.sources import listing

#: Letters of sequences and CIGAR operations by their codes, and the sizes of tag types; fixed values of the format.
BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
SCHEMA = "file string, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string"
BATCH = 10_000


class _Bytes:
    """Unpacked bytes of a stream of gzip members."""

    def __init__(self, stream):
        self.stream, self.ready, self.at = stream, b"", 0
        self.inflate = zlib.decompressobj(31)

    def take(self, n: int) -> bytes:
        """The next n bytes, fewer at the end."""
        parts, found = [], len(self.ready) - self.at
        if found < n:
            parts, self.at = [self.ready[self.at :]], 0
            while found < n:
                packed = self.inflate.unused_data or self.stream.read(1 << 16)
                if not packed:
                    self.ready = b"".join(parts)
                    out, self.at = self.ready, len(self.ready)
                    return out
                if self.inflate.eof:
                    self.inflate = zlib.decompressobj(31)
                parts.append(self.inflate.decompress(packed))
                found += len(parts[-1])
            self.ready = b"".join(parts)
        out = self.ready[self.at : self.at + n]
        self.at += n
        return out

    def numbers(self, form: str) -> tuple:
        size = struct.calcsize("<" + form)
        data = self.take(size)
        if len(data) < size:
            raise EOFError("the file ends within a record")
        return struct.unpack("<" + form, data)


def _tags(data: bytes, wanted: Sequence[str]) -> dict[str, int | None]:
    """Whole-number tags of a record's last part."""
    found, at = {}, 0
    while at + 3 <= len(data):
        name, kind, at = data[at : at + 2].decode(), chr(data[at + 2]), at + 3
        if kind in "ZH":
            at = data.index(0, at) + 1
        elif kind == "A":
            at += 1
        elif kind == "B":
            n = struct.unpack_from("<I", data, at + 1)[0]
            at += 5 + n * struct.calcsize(NUMBERS[chr(data[at])])
        else:
            value = struct.unpack_from("<" + NUMBERS[kind], data, at)[0]
            at += struct.calcsize(NUMBERS[kind])
            if name in wanted and kind != "f":
                found[name] = value
    return found


def records(stream, tags: Sequence[str]) -> Iterator[tuple]:
    """(qname, flag, rname, pos, mapq, cigar, seq, tags...) of a stream; unset places and sequences as in SAM text."""
    data = _Bytes(stream)
    if data.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    data.take(data.numbers("i")[0])
    names = []
    for _ in range(data.numbers("i")[0]):
        names.append(data.take(data.numbers("i")[0])[:-1].decode())
        data.take(4)
    while head := data.take(4):
        size = struct.unpack("<i", head)[0]
        r = data.take(size)
        if len(r) < size:
            raise EOFError("the file ends within a record")
        ref, pos, n_name, mapq, _, n_ops, flag, n_seq = struct.unpack_from("<iiBBHHHi", r)
        at = 32 + n_name
        ops = struct.unpack_from(f"<{n_ops}I", r, at)
        at += 4 * n_ops
        pairs = r[at : at + (n_seq + 1) // 2]
        at += len(pairs) + n_seq
        seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in pairs)[:n_seq]
        cigar = "".join(f"{o >> 4}{OPERATIONS[o & 15]}" for o in ops)
        found = _tags(r[at:], tags)
        yield (r[32 : 31 + n_name].decode(), flag, names[ref] if ref >= 0 else "*", pos + 1, mapq, cigar or "*", seq or "*", *(found.get(t) for t in tags))


def bam(spark: SparkSession, path: str, tags: Sequence[str] = ("NH", "HI", "NM", "AS"), mapped_only: bool = False) -> DataFrame:
    """Records of the BAM files at a path: the columns of ``sources.sam`` under the tags' own names, and the file.

    A file cut within a record is an error. mapped_only drops unmapped records while reading.
    """
    files = listing(spark, path, "*.bam").select("path")
    columns = [c.split()[0] for c in SCHEMA.split(", ")] + list(tags)

    def read(batches):
        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            for file in pdf["path"]:
                system, place = fs.FileSystem.from_uri(file.replace("file:/", "file:///", 1) if file.startswith("file:/") and not file.startswith("file://") else file)
                with system.open_input_stream(place, compression=None) as stream:
                    rows = []
                    for r in records(stream, tags):
                        if mapped_only and r[1] & 4:
                            continue
                        rows.append((file, *r))
                        if len(rows) == BATCH:
                            yield pd.DataFrame(rows, columns=columns).astype({t: "Int64" for t in tags})
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns).astype({t: "Int64" for t in tags})

    schema = SCHEMA + "".join(f", {t} int" for t in tags)
    n = spark.sparkContext.defaultParallelism
    return files.repartition(n).mapInPandas(read, schema)
