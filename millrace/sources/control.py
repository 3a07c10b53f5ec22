"""Control tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import fixed
from millrace.model import COLUMNS, DATASETS, DEPENDENCIES, RULES, Dataset, Rule, join_path
from millrace.settings import scratch
from millrace.sources.stored import read_table


def resolve_dependencies(dependencies: DataFrame, datasets: DataFrame) -> DataFrame:
    """Each dependency with its source dataset's columns."""
    return dependencies.join(
        datasets.withColumnRenamed("JOB_ID", "SOURCE_JOB_ID"),
        dependencies["SOURCE_DATASET_ID"] == datasets["DATASET_ID"], "inner")


def job_targets(datasets: DataFrame) -> DataFrame:
    """The dataset of each job that has exactly one."""
    per_job = datasets.groupBy("JOB_ID").agg(
        F.count(F.lit(1)).alias("n"), F.max("DATASET_ID").alias("DATASET_ID"))
    return per_job.where(F.col("n") == 1).select("JOB_ID", "DATASET_ID")


def layouts(columns: DataFrame, datasets: DataFrame) -> DataFrame:
    """Column metadata of the given datasets."""
    return columns.join(datasets.select("DATASET_ID", "DATASET_NAME"), "DATASET_ID").orderBy(
        "DATASET_ID", "COLUMN_SEQUENCE_NUMBER")


def dependency_levels(edges: DataFrame) -> DataFrame:
    """JOB_ID and LEVEL of every job in `edges` (JOB_ID, NEEDS): 0 for jobs that need no other, else one
    more than the highest level needed. Jobs that need each other in a circle are an error.

    A round settles one level: it strikes the edges whose need the round before settled, and the jobs
    of struck edges that have no others left are next. What a round leaves is stored; a row per job
    and edge is kept, never a list per job. The joins are shuffled: a round's rows broadcast would
    pass the driver whole, in every round.
    """
    edges = _kept(edges.select("JOB_ID", "NEEDS").where(
        "JOB_ID is not null and NEEDS is not null").distinct())
    jobs = _kept(edges.select("JOB_ID").union(edges.select("NEEDS")).distinct())
    place = scratch(edges.sparkSession, "levels")
    fresh = _kept(jobs.join(edges.hint("merge"), "JOB_ID", "left_anti").withColumn(
        "LEVEL", F.lit(0)), f"{place}/0")
    level, left = 0, edges
    while not fresh.isEmpty():
        level += 1
        done = fresh.select(F.col("JOB_ID").alias("NEEDS")).hint("merge")
        struck = left.join(done, "NEEDS", "left_semi").select("JOB_ID").distinct()
        left = _kept(left.join(done, "NEEDS", "left_anti").select("JOB_ID", "NEEDS"))
        fresh = _kept(struck.join(left.hint("merge"), "JOB_ID", "left_anti").withColumn(
            "LEVEL", F.lit(level)), f"{place}/{level}")
    settled = edges.sparkSession.read.schema(fresh.schema).parquet(
        *(f"{place}/{i}" for i in range(level + 1)))
    circle = jobs.join(settled.hint("merge"), "JOB_ID", "left_anti").orderBy("JOB_ID").limit(20).collect()
    if circle:
        raise ValueError(f"jobs that need each other: {[r['JOB_ID'] for r in circle]}")
    return settled


def _kept(df: DataFrame, path: str | None = None) -> DataFrame:
    path = path or scratch(df.sparkSession, "levels")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Control:
    """The four control tables. Filters run in Spark; only rows of one job reach the driver."""

    all_datasets: DataFrame
    all_columns: DataFrame
    all_rules: DataFrame
    all_dependencies: DataFrame

    def datasets(self, job_id: int, dataset_type: str | None = None) -> DataFrame:
        mine = self.all_datasets.where(
            (F.col("JOB_ID") == job_id) & (F.col("ACTIVE_FLAG") == fixed.YES))
        return mine if dataset_type is None else mine.where(
            F.col("DATASET_TYPE") == dataset_type)

    def columns(self, dataset_id: int) -> DataFrame:
        one = self.all_datasets.where(F.col("DATASET_ID") == dataset_id).dropDuplicates(
            ["DATASET_ID"])
        return layouts(self.all_columns.where(F.col("DATASET_ID") == dataset_id), one)

    def rules(self, dataset_id: int) -> DataFrame:
        return self.all_rules.where(
            (F.col("DATASET_ID") == dataset_id) & (F.col("ACTIVE_FLAG") == fixed.YES))

    def dependencies(self, job_id: int) -> DataFrame:
        return self.all_dependencies.where(
            (F.col("JOB_ID") == job_id) & (F.col("ACTIVE_FLAG") == fixed.YES))

    def raw_datasets(self, job_id: int) -> list[Dataset]:
        found = self.datasets(job_id, fixed.RAW_TYPE).orderBy("DATASET_ID").collect()
        return [_dataset(r) for r in found]

    def layout(self, dataset_id: int) -> list[tuple[str, str]]:
        """(source, target) column names in file order."""
        return [(c["SOURCE_COLUMN_NAME"], c["COLUMN_NAME"])
                for c in self.columns(dataset_id).collect()]

    def declared_types(self, dataset_id: int) -> list[tuple[str, str]]:
        """(column, warehouse type) in table order."""
        return [(c["COLUMN_NAME"], c["COLUMN_DATA_TYPE"])
                for c in self.columns(dataset_id).collect()]

    def rule_list(self, dataset_id: int) -> list[Rule]:
        return [
            Rule(r["DATASET_ID"], r["QC_ID"], r["COLUMN_NAME"], r["QC_TYPE"], r["QC_PARAM"],
                 r["CRITICALITY"])
            for r in self.rules(dataset_id).collect()]

    def target(self, job_id: int) -> Dataset:
        """The one dataset a job builds."""
        mine = self.all_datasets.where(F.col("JOB_ID") == job_id)
        found = mine.join(job_targets(mine), ["JOB_ID", "DATASET_ID"], "left_semi").collect()
        if not found:
            raise LookupError(f"job {job_id} must have one target dataset, it has "
                              f"{'none' if mine.isEmpty() else 'several'}")
        return _dataset(found[0])

    def sources(self, job_id: int) -> list[Dataset]:
        """The datasets a job reads."""
        mine = self.dependencies(job_id)
        wanted = [r["SOURCE_DATASET_ID"] for r in
                  mine.select("SOURCE_DATASET_ID").distinct().collect()]
        names = [F.col("SOURCE_JOB_ID").alias("JOB_ID") if c == "JOB_ID" else
                 self.all_datasets[c] for c in DATASETS.names]
        found = [_dataset(r) for r in resolve_dependencies(
            mine.select("SOURCE_DATASET_ID").distinct(), self.all_datasets).select(
                *names).collect()]
        ids = [d.dataset_id for d in found]
        wrong = sorted(w for w in wanted if ids.count(w) != 1)
        if wrong or not wanted:
            raise LookupError(f"job {job_id}: source datasets missing or not unique: {wrong}")
        return sorted(found, key=lambda d: d.dataset_id)

    def levels(self) -> DataFrame:
        """JOB_ID and LEVEL of the jobs with active dependencies and of those that make what they
        read. A dataset is made by the job it belongs to."""
        made = self.all_datasets.select(
            F.col("DATASET_ID").alias("SOURCE_DATASET_ID"), F.col("JOB_ID").alias("NEEDS"))
        mine = self.all_dependencies.where(F.col("ACTIVE_FLAG") == fixed.YES)
        return dependency_levels(mine.join(made, "SOURCE_DATASET_ID").select("JOB_ID", "NEEDS"))

    def sources_of(self, target: Dataset, job_id: int) -> list[Dataset]:
        """Sources of a job with this target. A job may not overwrite what it reads."""
        sources = self.sources(job_id)
        if target.dataset_id in [s.dataset_id for s in sources]:
            raise ValueError(f"job {job_id} reads its own target {target.dataset_name}")
        return sources


def _dataset(row) -> Dataset:
    return Dataset(**{name.lower(): value for name, value in row.asDict().items()})


def load_control(spark: SparkSession, source: str | dict) -> Control:
    """Control tables as Parquet folders under a base folder, or as tables of one database.

    A missing table is an error.
    """
    def table(name, schema):
        where = {**source, "dbtable": name} if isinstance(source, dict) else join_path(source, name)
        return read_table(spark, where, schema, must_exist=True)

    return Control(
        table(fixed.DATASET_TABLE, DATASETS), table(fixed.COLUMN_TABLE, COLUMNS),
        table(fixed.RULE_TABLE, RULES), table(fixed.DEPENDENCY_TABLE, DEPENDENCIES))
