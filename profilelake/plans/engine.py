"""The query tools over one store, by the names a caller knows."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilelake.functions.cleaning import iso_date
from profilelake.operators import documents, lookup, nearest, series, stats, vectors
from profilelake.plans.ingest import Store
from profilelake.sources import documents as docstore

SUMMARY_CHARS = 200


def search_rows(hits: DataFrame) -> DataFrame:
    """Search hits as a caller sees them: id, float, place, relevance, start of the summary."""
    return hits.select(
        "query_id",
        "rank",
        F.col("id").alias("profile_id"),
        "metadata.platform_number",
        "metadata.latitude",
        "metadata.longitude",
        F.round(1 - F.col("distance"), 2).alias("relevance"),
        F.substring("document", 1, SUMMARY_CHARS).alias("summary"),
    )


class Engine:
    """Retrieval, search and chart-series tools. Every method returns a DataFrame; searches
    collect their query vectors while the plan is built."""

    def __init__(self, store: Store, make_model: Callable = vectors.hashing_model):
        self.store = store
        self.make_model = make_model

    @property
    def profiles(self) -> DataFrame:
        return self.store.read("profiles")

    @property
    def bgc_profiles(self) -> DataFrame:
        return self.store.read("bgc_profiles")

    @property
    def floats(self) -> DataFrame:
        return self.store.read("floats")

    @property
    def documents(self) -> DataFrame:
        return self.store.read("documents")

    # search documents

    def build_embeddings(
        self, collection: str = "all", limit: int | None = None, reset: bool = False
    ) -> DataFrame:
        """Build, embed and store the documents of one collection or of all.

        The model runs on new and changed texts only; ``reset`` runs it on all, as another
        model needs.
        """
        if reset and self.store.exists("documents"):
            docstore.reset_collections(self.store)
        docs, _ = documents.split_errors(
            documents.build_documents(
                self.profiles, self.bgc_profiles, self.floats, collection, limit
            )
        )
        if not self.store.exists("documents") or "embedding" not in self.documents.columns:
            made = vectors.embed_documents(docs, self.make_model)
        else:
            key = ["collection", "id", "document"]
            known = self.documents.where("embedding is not null").select(*key, "embedding")
            new = docs.join(known, key, "left_anti")
            made = vectors.embed_documents(new, self.make_model).unionByName(docs.join(known, key))
        return docstore.upsert_documents(self.store, made)

    def query_collection(
        self,
        collection: str,
        text: str,
        n: int = 10,
        where: dict | Column | None = None,
        contains: str | None = None,
    ) -> DataFrame:
        """Nearest documents of a collection; an empty one gives no rows."""
        corpus = self.documents.where(F.col("collection") == collection)
        queries = vectors.text_queries(self.store.spark, [text], self.make_model)
        hits = vectors.semantic_search(corpus, queries, n, where, contains, few=True)
        return vectors.with_documents(hits, corpus, ["id"])

    def query_all(self, text: str, n: int = 5, where: dict | Column | None = None) -> DataFrame:
        corpus = self.documents
        queries = vectors.text_queries(self.store.spark, [text], self.make_model)
        hits = vectors.search_all(corpus, queries, n, where, few=True)
        return vectors.with_documents(hits, corpus, ["collection", "id"])

    def get_stats(self) -> DataFrame:
        return stats.collection_stats(self.documents)

    # retrieval

    def _dated(self, hits: DataFrame, table: DataFrame) -> DataFrame:
        """Search rows with the date of the profile; the few hits are the small side."""
        dates = table.selectExpr("profile_id", f"{iso_date('timestamp')} as date")
        return search_rows(hits).join(dates, "profile_id", "left")

    def search_profiles(self, query: str, limit: int = 5) -> DataFrame:
        return self._dated(self.query_collection("profiles", query, limit), self.profiles)

    def search_bgc_profiles(self, bgc_parameter: str, limit: int = 5) -> DataFrame:
        """BGC profiles that measure the parameter, best match of the fixed sentence first.

        Without documents of BGC profiles the table answers, in the order of its ids and
        without a relevance.
        """
        name = bgc_parameter.upper()
        if not self.store.exists("documents") or self.documents.where(
            "collection = 'bgc_profiles'"
        ).isEmpty():
            return self._bgc_rows(name, limit)
        sentence = f"BGC profile measuring {name} dissolved oxygen chlorophyll"
        measures = F.array_contains("metadata.bgc_parameters", name)
        hits = self.query_collection("bgc_profiles", sentence, limit, measures)
        return self._dated(hits, self.bgc_profiles)

    def _bgc_rows(self, name: str, limit: int) -> DataFrame:
        rows = self.bgc_profiles.where(F.array_contains("bgc_parameters", name)).orderBy("profile_id")
        ranked = F.row_number().over(Window.partitionBy("query_id").orderBy("profile_id"))
        return rows.limit(limit).withColumn("query_id", F.lit(0)).select(
            "profile_id", "query_id", ranked.alias("rank"), "platform_number", "latitude",
            "longitude", F.lit(None).cast("double").alias("relevance"),
            F.lit(None).cast("string").alias("summary"),
            F.expr(iso_date("timestamp")).alias("date"),
        )

    def get_float_info(self, platform_number: str) -> DataFrame:
        return lookup.float_info(self.floats, platform_number)

    def get_float_profiles(
        self, platform_number: str, limit: int = 20, start_date: str = "", end_date: str = ""
    ) -> DataFrame:
        return lookup.float_profiles(
            self.profiles, self.bgc_profiles, platform_number, limit, start_date, end_date
        )

    def get_profile_data(
        self, profile_id: str, parameters: str = "temp,psal", use_adjusted: bool = False
    ) -> DataFrame:
        return lookup.profile_data(
            self.profiles, self.bgc_profiles, [profile_id], parameters, use_adjusted
        )

    def get_nearest_floats(self, lat: float, lon: float, max_distance_km: float = 500) -> DataFrame:
        return nearest.nearest_floats(self.profiles, lat, lon, max_distance_km)

    def aggregate_statistics(
        self,
        min_depth: float,
        max_depth: float,
        parameter: str = "temp",
        start_date: str = "",
        end_date: str = "",
    ) -> DataFrame:
        return stats.aggregate_statistics(
            self.profiles, self.bgc_profiles, min_depth, max_depth, parameter, start_date, end_date
        )

    def get_dataset_metadata(self) -> DataFrame:
        return stats.dataset_metadata(self.profiles, self.bgc_profiles, self.floats)

    # charts: the series to draw, and the specification that names them

    def _on_profiles(self, fn: Callable, *args) -> DataFrame:
        return partial(fn, self.profiles, self.bgc_profiles)(*args)

    def float_trajectory(self, platform_number: str) -> DataFrame:
        return series.trajectory(self.profiles, platform_number).orderBy("cycle_number", "profile_id")

    def visualize_float_trajectory(self, platform_number: str) -> DataFrame:
        return series.trajectory_spec(self.profiles, self.floats, platform_number)

    def profile_depth_series(self, profile_id: str, parameters: str = "temp") -> DataFrame:
        return self._on_profiles(series.depth_series, [profile_id], parameters)

    def visualize_profile_depth_plot(self, profile_id: str, parameters: str = "temp") -> DataFrame:
        return self._on_profiles(series.depth_spec, [profile_id], parameters)

    def ts_series(self, profile_ids: list[str]) -> DataFrame:
        return self._on_profiles(series.ts_pairs, profile_ids)

    def visualize_ts_diagram(self, profile_ids: list[str]) -> DataFrame:
        return self._on_profiles(series.ts_spec, profile_ids)

    def comparison_series(self, profile_ids: list[str], parameter: str = "temp") -> DataFrame:
        return self._on_profiles(series.compare_series, profile_ids, parameter)

    def compare_profiles_depth(self, profile_ids: list[str], parameter: str = "temp") -> DataFrame:
        return self._on_profiles(series.comparison_spec, profile_ids, parameter)

    def scatter_series(
        self, profile_ids: list[str], param_x: str = "psal", param_y: str = "temp"
    ) -> DataFrame:
        return self._on_profiles(series.scatter_pairs, profile_ids, param_x, param_y)

    def visualize_parameter_scatter(
        self, profile_ids: list[str], param_x: str = "psal", param_y: str = "temp"
    ) -> DataFrame:
        return self._on_profiles(series.scatter_spec, profile_ids, param_x, param_y)

    def map_markers(self, profile_ids: list[str]) -> DataFrame:
        return self._on_profiles(series.markers, profile_ids)

    def map_marker_display(self, profile_ids: list[str]) -> DataFrame:
        return self._on_profiles(series.markers_spec, profile_ids)
