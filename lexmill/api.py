"""The engine's verbs: ingest, list_sources, export_pairs, export_ranked, build_index."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import export, index, merge, rank
from .runtime import keeping, publish, scratch, write_json
from .schema import GIVEN
from .sources import catalog as C


class Lexicon:
    """A merged lexicon in a folder: entries, costs, clicks and sources as tables, report.json beside them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def catalog(self) -> list[dict]:
        return [json.loads(r["metadata"]) for r in self.table("sources").orderBy("ordinal").collect()]  # a row per source

    def ingest(self, catalog: list[dict]) -> DataFrame:
        """Read, check and merge all sources of a catalog; the lexicon changes as a whole or not at all. Returns counts (source, metric, n).

        Sources are read once: into a table of checked rows, while what there is to count of each is observed. A source of which no row is left after
        the rejects raises.
        """
        part_of = {C.COSTS: "costs", C.CLICKS: "clicks"}
        read, staged = [s["id"] for s in catalog], []
        seen = {i: Observation() for i in read}
        with keeping(self.spark), scratch(self.spark, "checked") as stage:
            for s in catalog:
                part = part_of.get(s["format"], "entries")
                rows = (merge.checked_titles if part == "clicks" else merge.checked)(C.noted(self.spark, s))
                staged.append(rows.observe(seen[s["id"]], *merge.metrics(C.NOTES)).where("given").drop("note", "given").withColumn("part", F.lit(part)))
            # Observed in the stage that writes, so that a task that runs twice counts once.
            reduce(DataFrame.unionByName, staged).write.partitionBy("part").parquet(stage)
            counted = [(i, m, n) for i in read for m, n in seen[i].get.items() if n or m == "parsed_pairs"]
            return self._merged(catalog, read, self.spark.read.schema(reduce(DataFrame.unionByName, staged).schema).parquet(stage), counted)

    def _merged(self, catalog: list[dict], read: list[str], rows: DataFrame, counted: list[tuple]) -> DataFrame:
        costs, clicks = rows.where("part = 'costs' AND reject IS NULL"), rows.where("part = 'clicks' AND reject IS NULL")
        parts = {
            "entries": merge.accepted(rows.where("part = 'entries'")).repartitionByRange("reading", "surface").sortWithinPartitions("reading", "surface", "source", "kind"), "costs": merge.least_costs(costs.drop("reading").withColumnRenamed("key", "reading")),
            "clicks": merge.total_clicks(clicks.withColumn("clicks", F.col("cost").cast("long")), cost="clicks"), "sources": C.source_table(self.spark, catalog), "counts": self.spark.createDataFrame(counted, "source string, metric string, n long"),
        }

        def writer(_, place: str) -> None:
            for name, df in parts.items():
                df.write.mode("overwrite").parquet(f"{place}/{name}")
            made = {name: self.spark.read.parquet(f"{place}/{name}") for name in ("entries", "costs", "clicks")}
            found = merge.per_source(made["entries"].select("source", "confidence").unionByName(reduce(DataFrame.unionByName, (made[k].select("source", F.lit(GIVEN).alias("confidence")) for k in ("costs", "clicks")))), list(read))
            unique = {r["id"]: r for r in found.collect()}  # one row per source
            if empty := [i for i in read if not unique[i]["n"]]:
                raise ValueError(f"{', '.join(empty)} produced no vocabulary")
            totals = merge.totals(made["entries"]).first().asDict() | merge.ranking_totals(made["costs"], made["clicks"]).first().asDict()
            by_source = {r["source"]: {} for r in found.select(F.col("id").alias("source")).collect()}
            for r in self.spark.read.parquet(f"{place}/counts").collect():  # a dozen rows per source
                by_source[r["source"]][r["metric"]] = r["n"]
            for i, r in unique.items():
                by_source[i] |= {"unique_source_pairs": r["n"]} | ({"okuri_generated_unique_pairs": r["generated"]} if r["generated"] else {})
            write_json(self.spark, f"{place}/report.json", by_source | {"totals": totals})

        publish(parts["sources"], self.path, writer)
        return self.table("counts")

    def report(self) -> dict:
        """What the last ingest counted: by source, and in total."""
        return json.loads(self.spark.read.text(f"{self.path}/report.json", wholetext=True).first()[0])

    def traced(self) -> DataFrame:
        """Each entry with the version and the licence of its source."""
        return merge.traced(self.table("entries"), self.table("sources"))

    def list_sources(self) -> DataFrame:
        """id, version, license in the catalog's order."""
        get = lambda k: F.get_json_object("metadata", f"$.{k}").alias(k)
        return self.table("sources").orderBy("ordinal").select("id", get("version"), get("license"))

    def _selected(self, ids: list[str] | None) -> tuple[list[dict], list[str], DataFrame | None, DataFrame | None]:
        listed = self.catalog()
        chosen = C.select(listed, ids)
        of = lambda f: [s["id"] for s in listed if s["id"] in chosen and s["format"] == f]
        costs, clicks = of(C.COSTS), of(C.CLICKS)
        return listed, chosen, self.table("costs").where(F.col("source").isin(costs)) if costs else None, self.table("clicks").where(F.col("source").isin(clicks)) if clicks else None

    def pairs(self, ids: list[str] | None = None) -> DataFrame:
        return export.reading_pairs(self.table("entries"), self._selected(ids)[1])

    def ranked(self, ids: list[str] | None = None, shift_without_costs: bool = True) -> DataFrame:
        """kind, key, surface, position in dictionary order."""
        listed, chosen, costs, clicks = self._selected(ids)
        ordered = [s["id"] for s in listed if s["format"] == "skk"]
        entries = self.table("entries")
        nasi = rank.positions(rank.nasi_order(entries, chosen, costs, clicks, ordered, shift_without_costs))
        ari = rank.positions(rank.ari_order(entries, chosen, {s["id"]: k for k, s in enumerate(listed)}, costs))
        return export.ranked_pairs(ari, nasi)

    def export_pairs(self, path: str, ids: list[str] | None = None) -> str:
        """Write reading-surface lines; returns the manifest."""
        export.write_pairs(self.pairs(ids), path)
        return export.manifest(self.spark, path, self.catalog(), self._selected(ids)[1])

    def export_ranked(self, path: str, ids: list[str] | None = None, headers: tuple[str, ...] = ()) -> str:
        """Write the dictionary; returns the manifest, with its counts and the generated candidates' origins."""
        listed, chosen, *_ = self._selected(ids)
        stats = export.write_dictionary(export.judged_pairs(export.non_empty(self.ranked(ids))), path, headers)
        made = {r["metric"]: r["n"] for r in rank.origins(self.table("entries"), chosen).collect()}
        return export.manifest(self.spark, path, listed, chosen, dictionary=stats, okuri_ari=made)

    def build_index(self, path: str, ids: list[str] | None = None) -> None:
        index.build(export.non_empty(self.pairs(ids)), path)
