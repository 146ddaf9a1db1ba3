"""FASTA as a Spark data source: ``spark.read.format("fasta")`` gives chunks (chrom, chunk, seq) by byte ranges.

Options: ``path``, a FASTA file with its index beside it (.fai) or a folder that ``write_fasta`` made;
``chunk``, bases of a chunk; ``bytes``, bytes of a partition, about; ``chroms``, names in a JSON list,
and ``low`` and ``past``, numbers of chunks, that prune what is read.  Long sequences are cut into
ranges of whole chunks, short ones share partitions, and every range is one read; what the options
exclude is never read.  Filters are not pushed down by themselves: Spark 4.1 keeps what one plan of a
table has pushed to a Python source for the table's other plans too, which would lose rows.

Files are opened by pyarrow's file systems, so a path may name a shared folder, HDFS or an object
store.  The driver holds the index, a row a sequence; more than MAX_SEQUENCES are an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK, BYTES, MAX_SEQUENCES = 1 << 16, 16 << 20, 2_000_000
#: Bases a line that write_fasta writes, and the name of its index in the folder.
LINE, INDEX = 60, "_index"
SCHEMA = "chrom string, chunk long, seq string"


@dataclass(frozen=True)
class Sequence:
    """A row of an index: where a sequence's bases stand."""

    name: str
    length: int
    offset: int
    linebases: int
    linewidth: int
    file: str

    def at(self, base: int) -> int:
        return self.offset + base // self.linebases * self.linewidth + base % self.linebases


@dataclass
class Ranges(InputPartition):
    """(sequence, first chunk, past-last chunk) that one task reads."""

    parts: list[tuple[Sequence, int, int]]


def read_index(path: str) -> list[Sequence]:
    """The index of a FASTA file, or of a folder of them."""
    system, name = FileSystem.from_uri(path)
    if system.get_file_info(name).type == FileType.Directory:
        files = [f.path for f in system.get_file_info(FileSelector(f"{name}/{INDEX}")) if f.path.rsplit("/", 1)[1].startswith("part-")]
    else:
        files = [f"{name}.fai"]
    out = []
    for file in sorted(files):
        with system.open_input_stream(file) as stream:
            for line in stream.read().decode().splitlines():
                own = line.split("\t")
                out.append(Sequence(own[0], *map(int, own[1:5]), f"{name}/{own[5]}" if len(own) > 5 else name))
        if len(out) > MAX_SEQUENCES:
            raise ValueError(f"more than {MAX_SEQUENCES} sequences")
    return out


class FastaReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.chunk, self.bytes = options["path"], int(options.get("chunk", CHUNK)), int(options.get("bytes", BYTES))
        names = options.get("chroms")
        self.names = set(json.loads(names)) if names is not None else None
        self.low, self.past = int(options.get("low", 0)), int(options["past"]) if "past" in options else None

    def partitions(self) -> list[Ranges]:
        out, open_, held, step = [], [], 0, max(1, self.bytes // self.chunk)
        for seq in read_index(self.path):
            if self.names is not None and seq.name not in self.names:
                continue
            chunks = -(-seq.length // self.chunk)
            chunks = chunks if self.past is None else min(chunks, self.past)
            for k in range(self.low, chunks, step):
                part = (seq, k, min(k + step, chunks))
                open_.append(part)
                held += (part[2] - k) * min(self.chunk, seq.length)
                if held >= self.bytes:
                    out.append(Ranges(open_))
                    open_, held = [], 0
        return [*out, Ranges(open_)] if open_ or not out else out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = FileSystem.from_uri(self.path)
        files = {}
        try:
            for seq, first, past in partition.parts:
                if seq.file not in files:
                    files[seq.file] = system.open_input_file(seq.file)
                low, high = first * self.chunk, min(past * self.chunk, seq.length)
                raw = files[seq.file].read_at(seq.at(high - 1) + 1 - seq.at(low), seq.at(low))
                bases = raw.replace(b"\n", b"").replace(b"\r", b"").decode()
                seqs = [bases[k : k + self.chunk] for k in range(0, len(bases), self.chunk)]
                yield pa.RecordBatch.from_pydict({"chrom": pa.array([seq.name] * len(seqs)), "chunk": pa.array(range(first, first + len(seqs)), pa.int64()), "seq": pa.array(seqs)})
        finally:
            for file in files.values():
                file.close()


class FastaDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(FastaDataSource)


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK, chroms: list[str] | None = None, **options) -> DataFrame:
    """Chunks of all sequences, or of the named ones."""
    register(spark)
    names = {} if chroms is None else {"chroms": json.dumps(chroms)}
    return spark.read.format("fasta").options(path=path, chunk=chunk, **names, **options).load()


def write_fasta(records: DataFrame, path: str, line: int = LINE) -> None:
    """Writes records (name, sequence) as a folder of FASTA files, one a task, and their index.

    The index is made of what finished tasks report, so that files of lost attempts are never read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        file, offset = f"{uuid.uuid4().hex}.fa", 0
        with system.open_output_stream(f"{folder}/{file}") as out:
            for batch in batches:
                index = []
                for name, seq in zip(batch["name"], batch["sequence"], strict=True):
                    head = f">{name}\n".encode()
                    body = "".join(seq[k : k + line] + "\n" for k in range(0, len(seq), line)).encode()
                    out.write(head + body)
                    index.append((name, len(seq), offset + len(head), line, line + 1, file))
                    offset += len(head) + len(body)
                yield pd.DataFrame(index, columns=["name", "length", "offset", "linebases", "linewidth", "file"])

    index = records.select("name", "sequence").mapInPandas(run, "name string, length long, offset long, linebases long, linewidth long, file string")
    index.where("length > 0").write.csv(f"{path}/{INDEX}", sep="\t")
