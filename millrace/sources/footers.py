"""Parquet footers as a table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import file_names

FOOTER_DDL = (
    "file STRING, row_group INT, group_rows BIGINT, column STRING, physical_type STRING, encodings STRING, "
    "codec STRING, compressed_bytes BIGINT, uncompressed_bytes BIGINT, min STRING, max STRING, null_count BIGINT"
)


def parquet_footers(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per file, row group and column. Executors read the footers; no data page is touched."""
    wanted = set(columns) if columns else None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            for uri in batch["path"]:
                store, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                with store.open_input_file(name) as f:
                    yield _rows(uri, pq.ParquetFile(f).metadata, wanted)

    files = file_names(spark, path)
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(read, FOOTER_DDL)


def _rows(uri: str, footer, wanted: set[str] | None) -> pd.DataFrame:
    rows = []
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        for c in range(group.num_columns):
            chunk = group.column(c)
            if wanted is not None and chunk.path_in_schema not in wanted:
                continue
            stats = chunk.statistics
            ranged = stats is not None and stats.has_min_max
            rows.append(
                (uri, g, group.num_rows, chunk.path_in_schema, chunk.physical_type, ",".join(chunk.encodings),
                 chunk.compression, chunk.total_compressed_size, chunk.total_uncompressed_size,
                 str(stats.min) if ranged else None, str(stats.max) if ranged else None,
                 stats.null_count if ranged else None)
            )
    return pd.DataFrame(rows, columns=[c.split()[0] for c in FOOTER_DDL.split(", ")])
