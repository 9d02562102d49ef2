"""Source plug-ins: any functions of a language that return candidate records become a Spark data source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from linkloom import schemas as S


def candidate_source(sources: dict[str, Callable[[str], list[dict]]], name: str = "candidates") -> type[DataSource]:
    """A data source class over the given functions, one partition each.  It carries them with it to the executors.

    Options: sources (a comma list; all by default) and language.  Records without a url are left out; missing fields are empty.
    """
    fields = [c.split()[0] for c in S.CANDIDATE.split(", ")]
    format_name = name

    class One(InputPartition):
        def __init__(self, source: str):
            super().__init__(source)
            self.source = source

    class Reader(DataSourceReader):
        def __init__(self, wanted: list[str], language: str):
            self.wanted, self.language = wanted, language

        def partitions(self):
            return [One(n) for n in self.wanted]

        def read(self, partition) -> Iterator[tuple]:
            for r in sources[partition.source](self.language):
                if r.get("url"):
                    yield tuple(str(r.get(k) or (partition.source if k == "source" else "")) for k in fields)

    class CandidateSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            return S.CANDIDATE

        def reader(self, schema) -> DataSourceReader:
            chosen = [x for x in self.options.get("sources", "").split(",") if x] or sorted(sources)
            return Reader(chosen, self.options.get("language", ""))

    return CandidateSource


def register(spark: SparkSession, sources: dict[str, Callable[[str], list[dict]]], name: str = "candidates") -> None:
    """spark.read.format(name) then reads the sources."""
    spark.dataSource.register(candidate_source(sources, name))
