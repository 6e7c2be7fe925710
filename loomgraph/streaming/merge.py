"""Graph upserts on a stream: each micro-batch of triples is merged into Parquet tables by key.

Every batch writes a folder of its own, so that it never overwrites what it reads; a small pointer table names the current
one, and a batch that was already merged is skipped. A folder goes when two later batches have been merged, so a reader of
the current one is not disturbed by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.operators import graph


class GraphSink:
    """Use with writeStream.foreachBatch(GraphSink(spark, folder))."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def current(self) -> tuple[int, DataFrame | None]:
        """Last merged batch and its edges."""
        try:
            last = self.spark.read.parquet(f"{self.folder}/pointer").agg({"batch": "max"}).first()[0]
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            last = None
        return (-1, None) if last is None else (last, self.spark.read.parquet(f"{self.folder}/edges-{last}"))

    def __call__(self, batch: DataFrame, number: int) -> None:
        last, old = self.current()
        if number <= last:
            return
        new = graph.last_per(graph.clean_edges(batch), graph.EDGE_KEY)
        merged = new if old is None else graph.merge(old, new, graph.EDGE_KEY)
        merged.write.mode("overwrite").parquet(f"{self.folder}/edges-{number}")
        older = [] if old is None else [r[0] for r in self.spark.read.parquet(f"{self.folder}/pointer").where(f"batch < {last}").orderBy("batch").collect()[-1:]]
        self.spark.createDataFrame([(number,)], "batch long").write.mode("append").parquet(f"{self.folder}/pointer")
        for batch_number in older:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/edges-{batch_number}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
