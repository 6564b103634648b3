"""Image measures, embeddings, standardisation and principal components."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F, types as T

from creascope.functions import pixels as px
from creascope.functions.columns import PCA_PREFIX
from creascope.session import stash

# The Python workers need not have this package installed: its functions travel with the task.
for module in (px, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(module)

MEASURES = list(px.UNREADABLE)


def _decode(data, height: int, width: int, channels: int) -> np.ndarray | None:
    """RGB pixels, or None for a file the image source could not read."""
    if data is None or height is None or not (height > 0 and width > 0):
        return None
    return px.to_rgb(data, int(height), int(width), int(channels))


READABLE = "height > 0 and width > 0 and data is not null"


def _fields(images: DataFrame) -> DataFrame:
    return images.select(
        "image.origin", "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")


def readable(images: DataFrame) -> DataFrame:
    """(origin, height, width, channels, data) of the images the image source could decode."""
    return _fields(images).filter(READABLE)


def _apart(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fields of all images in two parts: those that can be measured within their row, and the others.

    Others are images that share an origin or have none, and images whose bytes are missing or too many:
    these count in sums over pixel rows.
    """
    fields = _fields(images)
    whole = F.expr(f"not coalesce({READABLE}, false) or length(data) = cast(height as bigint) * width * channels")
    others = stash(fields.groupBy("origin").agg(F.count("*").alias("n"), F.bool_and(F.coalesce(whole, F.lit(False))).alias(
        "whole")).filter("n > 1 or not whole or origin is null").select(F.col("origin").alias("_other")), "others")
    same = F.col("origin").eqNullSafe(F.col("_other"))
    return fields.join(others, same, "left_anti"), fields.join(others, same, "left_semi")


def pixel_rows(images: DataFrame) -> DataFrame:
    """(origin, height, width, y, x, r, g, b): every pixel of every readable image.

    The stored bytes are cut into scan lines first and these into pixels, so that no row carries
    a whole image along. Bytes are blue, green, red and perhaps alpha, or one gray level.
    """
    return _pixels(readable(images))


def _pixels(sources: DataFrame) -> DataFrame:
    lines = sources.select("origin", "height", "width", "channels", F.posexplode(F.expr(
        "transform(sequence(0, height - 1), y -> substring(data, y * width * channels + 1, width * channels))"
    )).alias("y", "line"))
    packed = lines.select("origin", "height", "width", "channels", "y", F.posexplode(F.expr(
        "transform(sequence(0, width - 1), x -> cast(conv(hex(substring(line, x * channels + 1, channels)), 16, 10) as bigint))"
    )).alias("x", "bytes"))
    colour = packed.withColumn("bytes", F.expr(
        "case channels when 1 then bytes * 65793 when 4 then shiftright(bytes, 8) else bytes end"))
    return colour.select("origin", "height", "width", "y", "x", *[
        F.expr(f"cast(shiftright(bytes, {shift}) & 255 as int)").alias(c) for c, shift in (("r", 0), ("g", 8), ("b", 16))])


def resize_kernel(sizes: DataFrame, target: int) -> DataFrame:
    """(size, tap, out, weight): antialiased bicubic weights in 1/2**22 steps, for every size of ``sizes``."""
    near = "1.5D * d * d * d - 2.5D * d * d + 1"
    far = "-0.5D * d * d * d + 2.5D * d * d - 4 * d + 2"
    outs = sizes.selectExpr("size", f"size / {target} as ratio", f"explode(sequence(0, {target - 1})) as out").selectExpr(
        "size", "out", "greatest(ratio, 1D) as stretch", "(out + 0.5D) * ratio as centre")
    taps = outs.selectExpr("*", """explode(sequence(
        greatest(cast(centre - 2 * stretch + 0.5D as int), 0),
        least(cast(centre + 2 * stretch + 0.5D as int), size) - 1)) as tap""")
    raw = taps.selectExpr("size", "out", "tap", "abs((tap + 0.5D - centre) / stretch) as d").selectExpr(
        "size", "out", "tap", f"case when d < 1 then {near} when d < 2 then {far} else 0D end as raw")
    total = raw.groupBy("size", "out").agg(F.sum("raw").alias("total"))
    steps = F.col("raw") / F.col("total") * (1 << 22)
    return raw.join(total, ["size", "out"]).select(
        "size", "tap", "out", (steps + 0.5 * F.signum(steps)).cast("long").alias("weight")).filter("weight <> 0")


def kernel_arrays(kernel: DataFrame) -> DataFrame:
    """(size, outs): per size the (tap, weight) pairs of every output, in order."""
    outs = kernel.groupBy("size", "out").agg(F.array_sort(F.collect_list(F.struct("tap", "weight"))).alias("taps"))
    return outs.groupBy("size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("out", "taps"))), lambda o: o["taps"]).alias("outs"))


def thumbnails(images: DataFrame, size: int = px.THUMBNAIL) -> DataFrame:
    """(origin, y, x, r, g, b): every readable image in ``size`` x ``size`` pixels.

    Across, then down, with 8-bit rounding after each. An image is reduced within its row, one scan line
    after the other, so no pixel is shuffled. The weights depend on the edge lengths that occur and are
    stored, so the joins know how small they are. Images that share an origin are added up pixel by pixel.
    """
    return _thumbnails(readable(images), *_apart(images), size)


def _thumbnails(sources: DataFrame, single: DataFrame, others: DataFrame, size: int) -> DataFrame:
    edges = sources.select(F.explode(F.array("height", "width")).alias("size")).distinct()
    kernel = stash(resize_kernel(edges, size), "resize_kernel")
    shrunk = _shrunk(single.filter(READABLE), kernel_arrays(kernel), size)
    return shrunk.unionByName(_summed(others.filter(READABLE), kernel))


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _shrunk(sources: DataFrame, kernel: DataFrame, size: int) -> DataFrame:
    """Thumbnails of images with distinct origins, without a shuffle of pixels.

    Red and green travel as the halves of one long, blue as another: a weighted sum of bytes stays
    within 32 bits, sign included. A line is the array of the first, followed by that of the second.
    """
    def byte(total: str) -> str:
        return f"greatest(least(shiftright({total} + {1 << 21}, 22), 255), 0)"

    def halves(total: str) -> tuple[str, str]:
        low = f"shiftright(shiftleft({total}, 32), 32)"
        return byte(low), byte(f"shiftright({total} - {low}, 32)")

    place = "(y * width + x) * channels + 1"
    read = f"cast(conv(hex(substring(data, {place}, channels)), 16, 10) as bigint)"
    colour = "transform(p, v -> case channels when 1 then v * 65793 when 4 then shiftright(v, 8) else v end)"
    red, green = halves("u")
    shrunk = f"""concat(
        {_let("c", "transform(p, v -> (v & 255) + shiftleft(v & 65280, 24))",
              f"transform(transform(across, ts -> aggregate(ts, 0L, (s, t) -> s + t.weight * c[t.tap])), u -> {red} + shiftleft({green}, 32))")},
        {_let("c", "transform(p, v -> shiftright(v, 16) & 255)",
              f"transform(across, ts -> {byte('aggregate(ts, 0L, (s, t) -> s + t.weight * c[t.tap])')})")})"""
    line = _let("p", f"transform(sequence(0, width - 1), x -> {read})", _let("p", colour, shrunk))
    sums = f"""aggregate(ts, array_repeat(0L, {2 * size}),
        (s, t) -> zip_with(s, lines[t.tap], (a, v) -> a + t.weight * v))"""
    rows = _let("lines", f"transform(sequence(0, height - 1), y -> {line})", f"transform(down, ts -> {sums})")
    weighted = sources.join(kernel.toDF("width", "across"), "width").join(kernel.toDF("height", "down"), "height")
    down = weighted.select("origin", F.posexplode(F.expr(rows)).alias("y", "sums")).select(
        "origin", "y", F.slice("sums", 1, size).alias("rg"), F.slice("sums", size + 1, size).alias("b"))
    pixels = down.select("origin", "y", F.posexplode(F.arrays_zip("rg", "b")).alias("x", "sum"))
    red, green = halves("sum.rg")
    return pixels.select("origin", "y", "x", *[
        F.expr(f"cast({value} as int)").alias(c) for c, value in zip("rgb", (red, green, byte("sum.b")))])


def _summed(sources: DataFrame, kernel: DataFrame) -> DataFrame:
    """Thumbnails by sums over pixel rows, where several images may share an origin.

    A pixel adds its share to the few outputs it reaches, and tasks add up whole lines before the shuffle.
    """
    def shrink(pixels: DataFrame, edge: str, at: str, keep: list[str]) -> DataFrame:
        reached = pixels.join(kernel, (pixels[edge] == kernel["size"]) & (pixels[at] == kernel["tap"]))
        sums = reached.groupBy(*keep, F.col("out").alias(at)).agg(
            *[F.sum(F.col("weight") * F.col(c)).alias(c) for c in "rgb"])
        return sums.select(*keep, at, *[
            F.greatest(F.least(F.shiftright(F.col(c) + (1 << 21), 22), F.lit(255)), F.lit(0)).cast("int").alias(c)
            for c in "rgb"])

    across = shrink(_pixels(sources), "width", "x", ["origin", "height", "y"])
    return shrink(across, "height", "y", ["origin", "x"]).select("origin", "y", "x", "r", "g", "b")


def colour_bit(r: Column, g: Column, b: Column) -> Column:
    """One bit of a long per colour bucket: there are 64, four levels a channel."""
    def level(channel: Column):
        return F.least(F.floor(channel * px.COLOR_LEVELS / 255), F.lit(px.COLOR_LEVELS - 1))

    return F.call_function("shiftleft", F.lit(1).cast("long"), (level(r) * 16 + level(g) * 4 + level(b)).cast("int"))


def thumbnail_diversity(images: DataFrame) -> DataFrame:
    """(origin, color_diversity_score): share of the colour buckets that the thumbnail of an image fills."""
    return _diversity(thumbnails(images))


def _diversity(thumbs: DataFrame) -> DataFrame:
    bits = F.bit_or(colour_bit(*(F.col(c) for c in "rgb")))
    return thumbs.groupBy("origin").agg((F.bit_count(bits) / px.COLOR_LEVELS**3).alias("color_diversity_score"))


def colour_measures(images: DataFrame) -> DataFrame:
    """Size and colour measures per image, without colour diversity; unreadable files get defaults.

    An image is measured within its row, so neither pixels nor sums of them are shuffled. Images that share
    an origin are added up pixel by pixel.
    """
    return _colours(*_apart(images))


def _colours(single: DataFrame, others: DataFrame) -> DataFrame:
    good = F.coalesce(F.expr(READABLE), F.lit(False))
    height, width = (F.col(edge).cast("double") for edge in ("height", "width"))
    sizes = [F.when(good, width / height).alias("aspect_ratio"), F.when(good, width).alias("image_width"),
             F.when(good, height).alias("image_height")]
    names = ["origin", "aspect_ratio", "image_width", "image_height"]
    added = pixel_features(_pixels(others.filter(READABLE)), "origin").drop("n_pixels", "color_diversity_score")
    alone = _measured(_row_sums(single.select("*", *sizes), good), names)
    return alone.unionByName(others.select("origin", *sizes).join(added, "origin", "left"), allowMissingColumns=True).drop(
        "n_pixels", "color_diversity_score").na.fill(
        {name: value for name, value in px.UNREADABLE.items() if name != "color_diversity_score"})


def handcrafted_features(images: DataFrame) -> DataFrame:
    """All measures per image of Spark's ``image`` source, whose origins tell them apart.

    Everything is SQL over pixels; unreadable files get default values.
    """
    single, others = _apart(images)
    diversity = _diversity(_thumbnails(readable(images), single, others, px.THUMBNAIL))
    return _colours(single, others).join(diversity, "origin", "left").na.fill(
        {"color_diversity_score": px.UNREADABLE["color_diversity_score"]}).select("origin", *MEASURES)


def _pixel_terms(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """What the colour measures add up of a pixel."""
    red, green, blue = (c / 255.0 for c in (r, g, b))
    top, bottom = F.greatest(red, green, blue), F.least(red, green, blue)
    weights = px.BRIGHTNESS_WEIGHTS
    gray = sum((F.lit(w) * c for w, c in zip(px.GRAY_WEIGHTS, (r, g, b))), F.lit(px.GRAY_ROUNDING))
    return {
        "gray": F.shiftright(gray.cast("long"), 16),
        "light": weights[0] * red + weights[1] * green + weights[2] * blue,
        "saturation": F.when(top > 0, (top - bottom) / top).otherwise(0.0),
        "rg": red - green,
        "yb": 0.5 * (red + green) - blue,
        "bucket": colour_bit(r, g, b),
    }


def _row_sums(sources: DataFrame, good: Column) -> DataFrame:
    """``sources`` with the means, buckets and histogram of the pixels of each row, NULL where it is not ``good``."""
    read = "cast(conv(hex(substring(data, i * channels + 1, channels)), 16, 10) as bigint)"
    colour = "transform(p, v -> case channels when 1 then v * 65793 when 4 then shiftright(v, 8) else v end)"
    # blue is the first byte; the sequence of a row that is not good is not looked at
    whole = f"transform(sequence(0, height * width - 1), i -> {read})"
    pixels = sources.withColumn("p", F.when(good, F.expr(_let("p", whole, colour)))).drop("data")

    def terms(v: Column) -> dict[str, Column]:
        return _pixel_terms(*(F.shiftright(v, shift).bitwiseAND(F.lit(255)) for shift in (0, 8, 16)))

    def mean(term: Callable[[dict[str, Column]], Column]) -> Column:
        return F.aggregate("p", F.lit(0.0), lambda total, v: total + term(terms(v))) / F.size("p")

    means = {c: mean(lambda t, c=c: t[c]) for c in ("light", "saturation", "rg", "yb")}
    means |= {f"{c}2": mean(lambda t, c=c: t[c] * t[c]) for c in ("rg", "yb")}
    bits = F.aggregate("p", F.lit(0).cast("long"), lambda seen, v: seen.bitwiseOR(terms(v)["bucket"]))
    # counts are the lengths of runs of equal gray levels
    grays = pixels.select(
        *[c for c in pixels.columns if c != "p"], F.when(F.col("p").isNotNull(), F.size("p")).alias("n_pixels"),
        *[value.alias(c) for c, value in means.items()], F.bit_count(bits).alias("n_buckets"),
        F.array_sort(F.transform("p", lambda v: terms(v)["gray"])).alias("grays"))
    ends = grays.withColumn("ends", F.expr(
        "filter(sequence(1, size(grays)), i -> i = size(grays) or grays[i] <> grays[i - 1])")).drop("grays")
    return ends.withColumn("histogram", F.expr(
        "transform(ends, (e, i) -> cast(if(i = 0, e, e - ends[i - 1]) as bigint))")).drop("ends")


def pixel_features(pixels: DataFrame, key: str = "filename") -> DataFrame:
    """The same colour measures from a long table of (key, r, g, b), entirely in SQL.

    Pixels are first reduced to at most 256 gray-level rows per image, partly before the
    shuffle, so an image of any size costs one small group. Colour diversity counts the
    buckets of all given pixels: there are 64, so one bit each of a long.
    """
    terms = _pixel_terms(*(F.col(c) for c in "rgb"))
    per_pixel = pixels.select(key, *[term.alias(name) for name, term in terms.items()])
    by_gray = per_pixel.groupBy(key, "gray").agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(c) for c in ("light", "saturation", "rg", "yb")],
        F.sum(F.col("rg") * F.col("rg")).alias("rg2"),
        F.sum(F.col("yb") * F.col("yb")).alias("yb2"),
        F.bit_or("bucket").alias("buckets"),
    )
    n = F.sum("n")
    sums = by_gray.groupBy(key).agg(
        n.alias("n_pixels"),
        *[(F.sum(c) / n).alias(c) for c in ("light", "saturation", "rg", "yb", "rg2", "yb2")],
        F.bit_count(F.bit_or("buckets")).alias("n_buckets"),
        F.collect_list("n").alias("histogram"),  # at most 256 counts
    )
    return _measured(sums, [key])


def _measured(sums: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the colour measures from the means, buckets and histogram of each image."""
    total = F.col("n_pixels") + px.ENTROPY_EPSILON

    def surprise(acc, count):
        share = count / total
        return acc - share * F.log2(share + px.ENTROPY_EPSILON)

    variance = (F.col("rg2") - F.col("rg") * F.col("rg")) + (F.col("yb2") - F.col("yb") * F.col("yb"))
    offset = F.sqrt(F.col("rg") * F.col("rg") + F.col("yb") * F.col("yb"))
    light = F.col("light")
    return sums.select(
        *keep, "n_pixels",
        light.alias("brightness_mean"),
        F.col("saturation").alias("saturation_mean"),
        (F.sqrt(F.greatest(variance, F.lit(0.0))) + px.MEAN_WEIGHT * offset).alias("colorfulness"),
        F.aggregate(F.array_sort("histogram"), F.lit(0.0), surprise).alias("visual_entropy"),
        (F.col("n_buckets") / px.COLOR_LEVELS**3).alias("color_diversity_score"),
        F.when(light < px.DARK_BELOW, 1.0).otherwise(0.0).alias("is_dark_background"),
        F.when(light > px.LIGHT_ABOVE, 1.0).otherwise(0.0).alias("is_light_background"),
    )


def embed_images(
    images: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = 16,
    image_size: int = 224,
) -> DataFrame:
    """(origin, embedding) with a caller's model, loaded once per Python worker.

    The model gets float32 batches of shape (n, 3, size, size). An unreadable image keeps its
    place as an all-zero input. Only the stored bytes cross to Python; the much larger tensors
    are built there, one batch at a time.
    """
    def make():
        predict = make_predict_fn()

        def on_bytes(data, height, width, channels):
            batch = np.zeros((len(data), 3, image_size, image_size), np.float32)
            for i, fields in enumerate(zip(data, height, width, channels)):
                rgb = _decode(*fields)
                if rgb is not None:
                    batch[i] = px.model_tensor(rgb, image_size)
            return np.asarray(predict(batch), dtype=np.float32)

        return on_bytes

    embed = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    image = F.col("image")
    return images.select(
        image["origin"].alias("origin"),
        embed(image["data"], image["height"], image["width"], image["nChannels"]).alias("embedding"))


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col(column).cast("array<double>")))


def fit_standardizer(df: DataFrame, column: str) -> PipelineModel:
    """Centre every dimension and divide by its population deviation; constants become 0.

    The library's scaler uses the sample deviation; the constant factor between the two is
    applied afterwards.
    """
    n = df.count()
    scaler = StandardScaler(
        withMean=True, withStd=True, inputCol="_vector", outputCol="_centred").fit(_vectors(df, column))
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    product = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * scaler.mean.size), inputCol="_centred", outputCol="_scaled")
    return PipelineModel([scaler, product])


def fit_projection(df: DataFrame, column: str, k: int = 32) -> PipelineModel:
    """Standardiser and the first ``min(k, n - 1)`` principal components.

    Saved and loaded with the usual writers, so that later images are projected alike.
    """
    standardizer = fit_standardizer(df, column)
    size = min(k, df.count() - 1)
    pca_ = PCA(k=size, inputCol="_scaled", outputCol="_components")
    return PipelineModel([*standardizer.stages, pca_.fit(standardizer.transform(_vectors(df, column)))])


def project(df: DataFrame, column: str, model: PipelineModel, output: str = "components") -> DataFrame:
    """Array column after the last stage of a fitted standardiser or projection."""
    outputs = [stage.getOutputCol() for stage in model.stages]
    result = model.transform(_vectors(df, column)).withColumn(output, vector_to_array(outputs[-1]))
    return result.drop("_vector", *outputs)


def standardize(df: DataFrame, column: str, output: str = "scaled") -> DataFrame:
    return project(df, column, fit_standardizer(df, column), output)


def explained_variance(projection: PipelineModel) -> list[float]:
    """Share of the variance per component."""
    return list(projection.stages[-1].explainedVariance.toArray())


def widen(df: DataFrame, column: str, k: int, prefix: str = PCA_PREFIX) -> DataFrame:
    """Array column -> ``prefix0..prefix{k-1}`` columns; missing entries are 0.0."""
    return df.withColumns({
        f"{prefix}{i}": F.coalesce(F.get(column, F.lit(i)), F.lit(0.0)) for i in range(k)
    }).drop(column)


def file_name(origin: Column) -> Column:
    """Plain file name at the end of an image origin, which is a percent-encoded URI."""
    encoded = F.substring_index(origin, "/", -1)
    return F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)


def vision_table(
    registry: DataFrame,
    images: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
    k: int = 32,
    image_size: int = 224,
    batch_size: int = 16,
    projection: PipelineModel | None = None,
) -> tuple[DataFrame, PipelineModel | None]:
    """One row per registered image: identity, measures and ``vision_pca_*``.

    ``registry`` comes from the asset scan, ``images`` from the image source; they are joined
    on the file name. Without a model the components are all 0.0. The projection is fitted on
    these images unless one is given, and returned.
    """
    identity = registry.select("filename", "slug", "request_id", "placement_type", "file_size_kb")
    measures = handcrafted_features(images)
    measures = measures.select(file_name(F.col("origin")).alias("filename"), *MEASURES)
    table = identity.join(measures, "filename", "left").na.fill(px.UNREADABLE)
    if make_predict_fn is None:
        return table.withColumns({f"{PCA_PREFIX}{i}": F.lit(0.0) for i in range(k)}), None
    # inference is the expensive step: run it once, then fit on the stored vectors
    embedded = stash(embed_images(images, make_predict_fn, batch_size, image_size), "embeddings")
    if projection is None:
        projection = fit_projection(embedded, "embedding", k)
    files = project(embedded, "embedding", projection).select(
        file_name(F.col("origin")).alias("filename"), "components")
    width = projection.stages[-1].getK()
    return widen(table.join(files, "filename", "left"), "components", width), projection
