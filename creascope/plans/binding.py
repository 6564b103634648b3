"""The domain tables, derived from the generic Parquet tables of a data folder.

Everything here is a projection or aggregation of a whole table, so the domain tables grow
with it. Campaigns are blocks of 25 users, each with three creatives.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from creascope.operators import kpi, linking
from creascope.operators.design import flatten_design
from creascope.operators.metrics import fold_summary, mean_importance, regression_metrics
from creascope.session import stash
from creascope.sinks.tables import run_importances, run_metrics
from creascope.sources.files import clean_inventory, describe_assets

CREATIVE_SLUG = "concat('adunit-c', campaign_no, if(campaign_no % 2 = 0, '-mob', '-mpu'))"
# every sixth creative has an id the design documents do not know
REQUEST_ID = "lpad(cast(idx as string), 20, if(idx % 6 = 5, 'x', '0'))"
FEATURE_NAMES = [
    "brightness", "brightness_mean", "buy_rate_cpe", "campaign_duration_days",
    "color_diversity", "color_saturation_mean", "device_type_enc", "dominant_color_r",
    "geo_country_enc", "gross_cost_budget", "has_video", "is_dark_background",
    "n_engagement_labels", "platform_os_enc", "saturation_mean", "vision_pca_0",
    "vision_pca_10", "visual_entropy", "volume_agreed", "aspect_ratio",
]
N_COMPONENTS = 32
N_PIXELS = 21


class Domain:
    """Lazy domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_inventory(self) -> DataFrame:
        # json_tuple is a generator: the text is parsed once per row, while a plain JSON
        # expression would be repeated in every filter that is pushed down
        events = self.table("events").select(
            "event_id", "user_id", "event_type", "value", "ts", F.json_tuple("props", "k").alias("k"),
        ).selectExpr(
            "event_id", "user_id", "event_type", "value", "ts",
            "user_id div 25 as campaign_no", "cast(k as bigint) as k",
        ).selectExpr("*", "3 * campaign_no + k % 3 as idx")
        return events.selectExpr(
            "event_id", "value", "k",
            "if(user_id % 50 = 47, null, concat('camp_', lpad(cast(campaign_no as string), 4, '0'))) as campaign_id",
            f"if(user_id % 50 = 49, 'noslash', concat({CREATIVE_SLUG}, '/', {REQUEST_ID})) as game_key",
            """case event_type
                 when 'view' then if(k % 10 = 0, ' Impression ', 'impression')
                 when 'purchase' then if(value < 30, 'first_dropped', 'purchase')
                 when 'click' then if(value < 15, 'click-through-event', 'click')
                 else event_type end as type""",
            "case when user_id % 25 = 24 then null when user_id % 2 = 0 then 'smartphone' else 'tablet' end as device_type",
            "if(user_id % 4 < 2, 'ios', 'android') as platform_os",
            "if(user_id % 5 = 0, 'USA', 'SGP') as geo_country",
            "ts as browser_ts",
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return clean_inventory(self.raw_inventory)

    @cached_property
    def raw_briefing(self) -> DataFrame:
        """Submissions as text: day-first dates, some unreadable dates and numbers."""
        orders = self.table("orders").selectExpr("*", "o_custkey div 25 + 1 as campaign_no")
        return orders.selectExpr(
            "if(o_custkey % 97 = 0, null, concat('camp_', lpad(cast(campaign_no as string), 4, '0'))) as campaign_id",
            "o_orderkey as submission_id",
            "date_format(o_orderdate, 'dd/MM/yyyy') as submission_date",
            "concat('Campaign ', campaign_no) as campaign_name",
            "o_orderpriority as campaign_objectives",
            "o_orderstatus as kpis",
            "if(o_orderpriority = '5-LOW', 'to be set', date_format(o_orderdate, 'yyyy-MM-dd')) as startdate",
            "date_format(date_add(o_orderdate, cast(o_orderkey % 60 - 10 as int)), 'd/M/yyyy') as enddate",
            "if(o_orderstatus = 'F', 'USD', 'EUR') as currency",
            "if(o_orderkey % 11 = 0, 'tbc', cast(o_totalprice / 1000000 as string)) as buy_rate_cpe",
            "cast(o_orderkey as string) as volume_agreed",
            "cast(o_totalprice as string) as gross_cost_budget",
        )

    @cached_property
    def briefing(self) -> DataFrame:
        return linking.clean_briefing(self.raw_briefing, tie=["submission_id"])

    @cached_property
    def campaigns(self) -> DataFrame:
        return linking.campaigns(self.raw_briefing, tie=["submission_id"])

    @cached_property
    def design_docs(self) -> DataFrame:
        """One JSON document per supplier and line status; at most seven colours each."""
        lines = self.table("lineitem").groupBy("l_suppkey", "l_linestatus", "l_linenumber").agg(
            F.max("l_quantity").alias("most"), F.min("l_quantity").alias("least"),
            F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"),
            F.count("*").alias("n"))
        grouped = lines.groupBy("l_suppkey", "l_linestatus").agg(
            F.array_sort(F.collect_list(F.struct(
                "l_linenumber", "most", "least", "discount", "tax", "n"))).alias("lines"),
            F.sum("n").alias("n_lines"), F.max("most").alias("most"))

        def names(prefix: str, condition: str) -> str:
            kept = f"filter(lines, x -> {condition})"
            return f"transform({kept}, x -> concat('{prefix}', x.l_linenumber))"

        color = """named_struct('red', x.most * 5, 'green', x.discount * 1000, 'blue', x.least * 5,
            'proportion', x.tax, 'saturation', if(x.l_linenumber = 3, null, x.discount * 10),
            'luminosity', x.tax * 10)"""
        color_key = "concat(if(l_suppkey % 4 = 3, 'c', ''), x.l_linenumber)"
        record = f"""named_struct(
            'labels', named_struct('engagement', {names('label', 'x.discount >= 0.1')},
                                   'click_through', {names('label', 'x.least <= 1')}),
            'text', named_struct('engagement', {names('text', 'x.n % 2 = 0')},
                                 'click_through', {names('text', 'x.n % 3 = 0')}),
            'colors', named_struct('engagement',
                map_from_entries(transform(lines, x -> struct({color_key}, {color})))),
            'videos_data', named_struct('has_video', if(n_lines % 2 = 1, 'true', '0'),
                'videos_length', map_from_entries(transform(
                    filter(lines, x -> x.n % 2 = 0), x -> struct(concat('v', x.l_linenumber), x.most)))),
            'direction', named_struct('direction',
                case l_suppkey % 3 when 0 then 'up' when 1 then 'left' end),
            'adunit_sizes', named_struct('size_x', cast(n_lines as double),
                'size_y', if(l_suppkey % 5 = 0, 0D, most * 10)))"""
        return grouped.selectExpr(
            "md5(concat('design-', l_linestatus, l_suppkey % 10)) as outer_key",
            "lpad(cast(l_suppkey as string), 20, '0') as request_id",
            f"{record} as record",
        ).selectExpr("to_json(map(outer_key, map(request_id, record))) as doc")

    @cached_property
    def design(self) -> DataFrame:
        return flatten_design(self.design_docs)

    @cached_property
    def assets(self) -> DataFrame:
        """Image registry from part names; a seventh of the ids has the wrong length."""
        suffix = "element_at(array('-mob', '-mpu', '-tap', '-bio', ''), p_size % 5 + 1)"
        width = "if(p_size % 7 = 0, 12, 20)"
        files = self.table("part").selectExpr(
            f"""concat('assets/adunit-', replace(p_name, ' ', '-'), {suffix}, '-',
                lpad(cast(p_partkey as string), {width}, '0'), '.png') as filepath""",
            "if(p_size % 11 = 0, null, cast(p_retailprice * 100 as bigint)) as length")
        return describe_assets(files)

    @cached_property
    def images_raw(self) -> DataFrame:
        return self.table("embeddings").selectExpr(
            "vec_id", "transform(embedding, x -> cast(x as double)) as e",
            "vec_id div 2 as idx", "vec_id div 6 as campaign_no",
        ).selectExpr("vec_id", "e", f"concat({CREATIVE_SLUG}, '-', {REQUEST_ID}, '.png') as filename")

    @cached_property
    def vision(self) -> DataFrame:
        """Image features; every file occurs twice."""
        components = [f"e[{i}] as vision_pca_{i}" for i in range(N_COMPONENTS)]
        return self.images_raw.selectExpr(
            "filename", "vec_id", "1 + e[0] as aspect_ratio",
            "if(vec_id % 9 = 0, null, abs(e[1])) as brightness_mean",
            "abs(e[2]) as saturation_mean", "abs(e[3]) as colorfulness",
            "abs(e[4]) * 8 as visual_entropy", "abs(e[5]) as color_diversity_score",
            "if(e[1] < 0, 1D, 0D) as is_dark_background", "if(e[2] > 0.1, 1D, 0D) as is_light_background",
            "vec_id / 10 as file_size_kb", *components)

    @cached_property
    def pixel_arrays(self) -> DataFrame:
        """21 pixels per image, from consecutive triples of its vector."""
        def channel(offset: int) -> str:
            unit = f"least(1D, greatest(0D, (e[3 * p + {offset}] + 0.6D) / 1.2D))"
            return f"cast(floor({unit} * 255) as int)"

        pixel = f"struct(p, {channel(0)} as r, {channel(1)} as g, {channel(2)} as b)"
        return self.images_raw.selectExpr(
            "vec_id", f"transform(sequence(0, {N_PIXELS - 1}), p -> {pixel}) as px")

    @cached_property
    def pixels(self) -> DataFrame:
        return self.pixel_arrays.selectExpr("vec_id", "inline(px)")

    @cached_property
    def images(self) -> DataFrame:
        """The same pixels as 7x3 images in the layout of Spark's image source."""
        pixel = "concat(lpad(hex(x.b), 2, '0'), lpad(hex(x.g), 2, '0'), lpad(hex(x.r), 2, '0'))"
        return self.pixel_arrays.selectExpr(f"""named_struct(
            'origin', cast(vec_id as string),
            'height', if(vec_id % 50 = 7, -1, 3), 'width', if(vec_id % 50 = 7, -1, 7),
            'nChannels', 3, 'mode', 16,
            'data', unhex(array_join(transform(px, x -> {pixel}), ''))) as image""")

    @cached_property
    def counts(self) -> DataFrame:
        """Event counts, stored: the dimensions and metrics below share this one scan of the log."""
        return stash(kpi.context_counts(self.inventory), "context_counts")

    @cached_property
    def creatives(self) -> DataFrame:
        return linking.creatives(self.counts, self.vision, vision_order=("vec_id",))

    @cached_property
    def metrics(self) -> DataFrame:
        return kpi.metrics_from_counts(self.counts, linking.creative_keys(self.counts))

    @cached_property
    def kpis(self) -> DataFrame:
        return kpi.creative_kpis(self.inventory)

    @cached_property
    def linked(self) -> DataFrame:
        return linking.link(self.kpis, self.design, self.briefing)

    @cached_property
    def predictions(self) -> DataFrame:
        """(run, model, fold, y, prediction) with zero targets and negative predictions."""
        return self.table("lineitem").selectExpr(
            "cast(trunc(l_shipdate, 'YEAR') as timestamp) as run_timestamp",
            """case when l_returnflag = 'A' then 'baseline' when l_returnflag = 'N' then 'tabular'
                 when l_linestatus = 'O' then 'vision' else 'multimodal' end as model""",
            "cast(l_suppkey % 5 as int) as fold",
            "l_discount * 10 as y", "l_tax * 10 - 0.1 as prediction",
            "l_quantity as importance",
            f"element_at(array({', '.join(repr(n) for n in FEATURE_NAMES)}), "
            f"cast(l_partkey % {len(FEATURE_NAMES)} + 1 as int)) as feature")

    @cached_property
    def benchmarks(self) -> DataFrame:
        """Run history of model metrics."""
        by = ("run_timestamp", "model")
        folds = regression_metrics(self.predictions, by=(*by, "fold"))
        n_features = F.length("model").cast("long").alias("n_features")
        models = fold_summary(folds, by).select("*", n_features, F.lit("engagement_rate").alias("target_metric"))
        return run_metrics(models, F.col("run_timestamp"))

    @cached_property
    def importances(self) -> DataFrame:
        """Run history of feature importances."""
        per_fold = self.predictions.groupBy("run_timestamp", "model", "fold", "feature").agg(
            F.sum("importance").alias("importance"))
        return run_importances(
            mean_importance(per_fold, 5, ("run_timestamp", "model")), F.col("run_timestamp"))

    @cached_property
    def labelled(self) -> DataFrame:
        """Modelling table: document quality by source."""
        labels = self.table("labels")
        documents = self.table("documents").select("doc_id", "lang", "source", "n_chars")
        return documents.join(labels, "doc_id")

    @cached_property
    def score_requests(self) -> DataFrame:
        return self.raw_inventory.selectExpr(
            "event_id", "device_type as device", "if(platform_os = 'ios', 'iOS', 'Android') as os",
            "geo_country as region", "value / 1000 as cpe", "cast(k as double) as brightness",
            "cast(k * 7 % 100 as double) as saturation", "cast(k * 3 % 100 as double) as colorfulness",
            "k % 2 = 0 as has_video")
