import struct
import zlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from creascope.functions import pixels as px
from creascope.operators import vision
from creascope.plans import jobs
from creascope.sources.files import read_images, scan_assets


def png(path, rgb):
    """Write an 8-bit RGB or RGBA PNG."""
    height, width, channels = rgb.shape
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, {3: 2, 4: 6}[channels], 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def solid(width, height, color):
    return np.tile(np.array(color, np.uint8), (height, width, 1))


NOISE = np.random.default_rng(11).integers(0, 256, (40, 30, 3), dtype=np.uint8)
IMAGES = {
    "adunit-blue-mob-00000000000000000001": solid(60, 60, (0, 0, 255)),
    "adunit-night-mpu-00000000000000000002": solid(72, 48, (12, 20, 31)),
    "adunit-snow-tap-00000000000000000003": solid(48, 72, (255, 255, 255)),
    "adunit-strip-bio-00000000000000000004": solid(30, 120, (90, 140, 60)),
    "adunit-noise": NOISE,
    "adunit-odd name+50%": solid(4, 4, (255, 255, 255)),
    "adunit-alpha": np.dstack([NOISE, np.full((40, 30), 7, np.uint8)]),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("images") / "Creative Assets_"
    path.mkdir()
    for name, rgb in IMAGES.items():
        png(path / f"{name}.png", rgb)
    (path / "adunit-broken.png").write_bytes(b"not an image")
    (path / "notes.txt").write_text("ignored")
    return str(path)


@pytest.fixture(scope="module")
def measured(spark, folder):
    rows = vision.handcrafted_features(read_images(spark, folder)).collect()
    return {r.origin.rsplit("/", 1)[1].split("-")[1].split(".")[0]: r for r in rows}


def test_all_measures_are_floats(measured):
    assert len(measured) == 8
    for row in measured.values():
        assert all(isinstance(row[m], float) for m in vision.MEASURES)


def test_aspect_and_size(measured):
    assert measured["blue"].aspect_ratio == 1.0
    assert measured["strip"].aspect_ratio == pytest.approx(30 / 120)
    assert (measured["strip"].image_width, measured["strip"].image_height) == (30.0, 120.0)


def test_flags(measured):
    assert (measured["night"].is_dark_background, measured["night"].is_light_background) == (1.0, 0.0)
    assert (measured["snow"].is_dark_background, measured["snow"].is_light_background) == (0.0, 1.0)


def test_ranges(measured):
    for row in measured.values():
        assert 0 <= row.brightness_mean <= 1 and 0 <= row.saturation_mean <= 1
        assert row.visual_entropy >= -1e-6


def test_solid_blue(measured):
    blue = measured["blue"]
    assert blue.brightness_mean == pytest.approx(0.0722) and blue.saturation_mean == 1.0
    assert blue.colorfulness == pytest.approx(0.3)
    assert blue.color_diversity_score == 1 / 64


def test_unreadable_file_gets_defaults(measured):
    assert {m: measured["broken"][m] for m in vision.MEASURES} == px.UNREADABLE


def test_alpha_is_ignored(measured):
    # sums of fractions depend on the order of the rows in their last digit
    assert [measured["alpha"][m] for m in vision.MEASURES] == pytest.approx(
        [measured["noise"][m] for m in vision.MEASURES], rel=1e-12)


def test_noise_against_direct_formulas(measured):
    unit = NOISE / 255.0
    r, g, b = unit[..., 0], unit[..., 1], unit[..., 2]
    top, low = unit.max(axis=2), unit.min(axis=2)
    row = measured["noise"]
    assert row.brightness_mean == pytest.approx((0.2126 * r + 0.7152 * g + 0.0722 * b).mean())
    assert row.saturation_mean == pytest.approx(np.where(top > 0, (top - low) / np.where(top > 0, top, 1), 0).mean())
    rg, yb = r - g, 0.5 * (r + g) - b
    assert row.colorfulness == pytest.approx(
        np.sqrt(rg.std() ** 2 + yb.std() ** 2) + 0.3 * np.sqrt(rg.mean() ** 2 + yb.mean() ** 2))


def test_pixel_table_gives_the_same_measures(spark, measured):
    rows = [("noise", *map(int, p)) for p in NOISE.reshape(-1, 3)] + [("blue", 0, 0, 255)] * 50
    table = spark.createDataFrame(rows, "filename string, r int, g int, b int")
    got = {r.filename: r for r in vision.pixel_features(table).collect()}
    for name in ("noise", "blue"):
        for m in ("brightness_mean", "saturation_mean", "colorfulness", "visual_entropy"):
            assert got[name][m] == pytest.approx(measured[name][m], abs=1e-8), m
    buckets = {tuple(np.minimum(p.astype(int) * 4 // 255, 3)) for p in NOISE.reshape(-1, 3)}
    assert got["noise"].color_diversity_score == len(buckets) / 64


def test_resize_keeps_solids_and_identity():
    assert (px.resize(solid(320, 480, (3, 128, 250)), 64, 64, "bicubic") == [3, 128, 250]).all()
    square = np.random.default_rng(2).integers(0, 256, (64, 64, 3), dtype=np.uint8)
    assert (px.resize(square, 64, 64, "bicubic") == square).all()
    halves = np.concatenate([solid(32, 64, (0, 0, 0)), solid(32, 64, (200, 200, 200))], axis=1)
    small = px.resize(halves, 2, 1, "bilinear")
    assert small[0, 0, 0] < 60 and small[0, 1, 0] > 140


def resample_line(line, size, kernel, support):
    """One line resized sample by sample, with the same 22-bit fixed point arithmetic."""
    ratio = len(line) / size
    stretch = max(ratio, 1.0)
    out = []
    for x in range(size):
        center = (x + 0.5) * ratio
        first = max(int(center - support * stretch + 0.5), 0)
        last = min(int(center + support * stretch + 0.5), len(line))
        weights = [kernel((i - center + 0.5) / stretch) for i in range(first, last)]
        total = sum(weights)
        steps = [w / total * 2**22 for w in weights]
        steps = [int(w - 0.5) if w < 0 else int(w + 0.5) for w in steps]
        value = 2**21 + sum(w * int(v) for w, v in zip(steps, line[first:last]))
        out.append(min(max(value >> 22, 0), 255))
    return out


def cubic(x, a=-0.5):
    x = abs(x)
    if x < 1:
        return ((a + 2) * x - (a + 3)) * x * x + 1
    return (((x - 5) * x + 8) * x - 4) * a if x < 2 else 0.0


@pytest.mark.parametrize("method, kernel, support", [
    ("bicubic", cubic, 2.0), ("bilinear", lambda x: max(1 - abs(x), 0.0), 1.0)])
@pytest.mark.parametrize("shape", [(3, 7), (40, 30), (97, 64), (64, 131)])
def test_resize_against_sample_by_sample_loops(method, kernel, support, shape):
    gray = np.random.default_rng(sum(shape)).integers(0, 256, shape)
    wide = [resample_line(row, 64, kernel, support) for row in gray]
    expected = np.array([resample_line(column, 64, kernel, support) for column in zip(*wide)]).T
    got = px.resize(np.repeat(gray[:, :, None], 3, axis=2).astype(np.uint8), 64, 64, method)
    assert (got[..., 0] == expected).all() and (got[..., 2] == expected).all()


def test_registry(spark, folder):
    rows = {r.filename: r for r in scan_assets(spark, folder).collect()}
    assert len(rows) == 8
    blue = rows["adunit-blue-mob-00000000000000000001.png"]
    assert (blue.slug, blue.request_id, blue.placement_type) == ("adunit-blue-mob", "00000000000000000001", "mobile")
    assert rows["adunit-noise.png"].request_id is None
    assert rows["adunit-broken.png"].file_size_kb == 0.01


def channel_means():
    """A model loader; defined inside, so that it travels to the workers by value."""
    def load():
        return lambda batch: batch.mean(axis=(2, 3))

    return load


def test_embedding_uses_zero_input_for_broken_images(spark, folder):
    embedded = vision.embed_images(read_images(spark, folder), channel_means(), batch_size=2, image_size=8)
    rows = {r.origin.rsplit("/", 1)[1]: r.embedding for r in embedded.collect()}
    assert rows["adunit-broken.png"] == [0.0, 0.0, 0.0]
    expected = (1.0 - np.array(px.CHANNEL_MEAN)) / np.array(px.CHANNEL_STD)
    assert rows["adunit-snow-tap-00000000000000000003.png"] == pytest.approx(list(expected), abs=1e-5)


def test_standardize(spark):
    x = np.random.default_rng(4).normal(size=(30, 3)) * [1, 5, 0] + [0, 2, 7]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id int, v array<double>")
    got = np.array([r.scaled for r in vision.standardize(df, "v").orderBy("id").collect()])
    assert got[:, :2] == pytest.approx(((x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1))[:, :2])
    assert (got[:, 2] == 0).all()


def test_principal_components(spark, tmp_path):
    x = np.random.default_rng(6).normal(size=(40, 5)) @ np.diag([5, 3, 1, 0.5, 0.1]) @ np.ones((5, 5)).cumsum(axis=0)
    x += np.random.default_rng(7).normal(size=x.shape)
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id int, v array<double>")
    model = vision.fit_projection(df, "v", 3)
    shares = np.array(vision.explained_variance(model))
    assert len(shares) == 3 and 0 < shares.sum() <= 1 and (np.diff(shares) <= 0).all()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    _, singular, axes = np.linalg.svd(z, full_matrices=False)
    assert shares == pytest.approx((singular ** 2 / (singular ** 2).sum())[:3], rel=1e-6)
    rows = vision.project(df, "v", model).orderBy("id")
    got = np.array([r.components for r in rows.collect()])
    assert np.abs(got) == pytest.approx(np.abs(z @ axes[:3].T), abs=1e-8)  # signs are free
    wide = vision.widen(rows, "components", 4)
    assert wide.columns[-4:] == [f"vision_pca_{i}" for i in range(4)]
    assert wide.filter("vision_pca_3 <> 0").isEmpty()
    assert vision.fit_projection(df.limit(3), "v", 5).stages[-1].getK() == 2
    # a stored projection gives other rows the same coordinates
    model.write().overwrite().save(str(tmp_path / "projection"))
    loaded = PipelineModel.load(str(tmp_path / "projection"))
    again = vision.project(df.limit(1), "v", loaded).first().components
    assert again == pytest.approx(list(got[0]))


@pytest.mark.parametrize("model", [None, channel_means()])
def test_vision_stage_has_one_row_per_file(spark, folder, model):
    table, projection = vision.vision_table(
        scan_assets(spark, folder), read_images(spark, folder), model, k=2, image_size=8)
    assert (projection is None) == (model is None)
    rows = {r.filename: r for r in table.collect()}
    assert len(rows) == 8 and len(set(table.columns)) == len(table.columns)
    assert rows["adunit-broken.png"].brightness_mean == 0.5
    for name in ("adunit-snow-tap-00000000000000000003.png", "adunit-odd name+50%.png"):
        assert rows[name].brightness_mean == pytest.approx(1.0)
    assert rows["adunit-strip-bio-00000000000000000004.png"].image_height == 120.0
    components = np.array([[r.vision_pca_0, r.vision_pca_1] for r in rows.values()], dtype=float)
    assert np.isfinite(components).all()
    assert (components == 0).all() == (model is None)


def test_vision_job_stores_registry_features_and_projection(spark, folder, tmp_path):
    out = str(tmp_path)
    first = {r.filename: r for r in jobs.build_vision(
        spark, out, folder, channel_means(), k=2, image_size=8).collect()}
    assert spark.read.parquet(f"{out}/raw_creative_assets").count() == 8
    assert len(vision.explained_variance(PipelineModel.load(f"{out}/models/projection"))) == 2
    again = jobs.build_vision(spark, out, folder, channel_means(), k=2, image_size=8, reuse_projection=True, force=True)
    for r in again.collect():
        assert r.vision_pca_0 == pytest.approx(first[r.filename].vision_pca_0, abs=1e-6)


def test_thumbnails_equal_the_resized_images(spark, folder):
    images = read_images(spark, folder)
    for size in (64, 16):
        found = {}
        for r in vision.thumbnails(images, size).collect():
            name = r.origin.rsplit("/", 1)[1][:-4]
            found.setdefault(name, np.zeros((size, size, 3), int))[r.y, r.x] = r.r, r.g, r.b
        assert len(found) == len(IMAGES)
        for name, rgb in IMAGES.items():
            same = next(v for k, v in found.items() if k.startswith(name[:10]))
            assert (same == px.resize(rgb[:, :, :3], size, size, "bicubic")).all()


def test_gray_images_and_empty_tables(spark):
    gray = [("g", 2, 3, 1, 0, bytearray([0, 50, 100, 150, 200, 255])), ("bad", -1, -1, -1, -1, bytearray())]
    images = spark.createDataFrame(
        [(row,) for row in gray],
        "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>")
    pixels = sorted((r.y, r.x, r.r, r.g, r.b) for r in vision.pixel_rows(images).collect())
    assert pixels == [(i // 3, i % 3, v, v, v) for i, v in enumerate([0, 50, 100, 150, 200, 255])]
    rows = {r.origin: r for r in vision.handcrafted_features(images).collect()}
    assert rows["g"].saturation_mean == 0 and {m: rows["bad"][m] for m in vision.MEASURES} == px.UNREADABLE
    assert vision.handcrafted_features(images.limit(0)).count() == 0


IMAGE = "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"


def stored_images(spark, named):
    rows = [((name, *rgb.shape, 16, bytearray(rgb[:, :, ::-1].tobytes())),) for name, rgb in named]
    return spark.createDataFrame(rows, IMAGE)


def test_thumbnails_shuffle_no_pixels(spark):
    draw = np.random.default_rng(8)
    named = [(f"i{i}", draw.integers(0, 256, (3 + i, 70 - i, 3), dtype=np.uint8)) for i in range(4)]
    thumbs = vision.thumbnails(stored_images(spark, named), 8)
    found = {name: np.zeros((8, 8, 3), int) for name, _ in named}
    for r in thumbs.collect():
        found[r.origin][r.y, r.x] = r.r, r.g, r.b
    for name, rgb in named:
        assert (found[name] == px.resize(rgb, 8, 8, "bicubic")).all()
    final = thumbs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "keys=[origin" not in final  # pixels are added up within the row of their image


def test_thumbnails_of_repeated_and_cut_images(spark):
    flat = [("twice", solid(2, 2, (10, 20, 200)))] * 2 + [(None, solid(2, 2, (1, 2, 3))), ("one", solid(2, 2, (5, 6, 7)))]
    images = stored_images(spark, flat).unionByName(spark.createDataFrame(
        [(("cut", 2, 2, 3, 16, bytearray([30, 20, 10] * 3)),)], IMAGE))
    found = {}
    for r in vision.thumbnails(images, 2).collect():
        found.setdefault(r.origin, {})[r.y, r.x] = (r.r, r.g, r.b)
    everywhere = lambda colour: dict.fromkeys([(0, 0), (0, 1), (1, 0), (1, 1)], colour)
    assert found["twice"] == everywhere((20, 40, 255)) and found[None] == everywhere((1, 2, 3))
    assert found["one"] == everywhere((5, 6, 7)) and found["cut"][0, 0] == (10, 20, 30)


def test_measures_shuffle_no_pixels(spark):
    draw = np.random.default_rng(9)
    named = [(f"i{i}", draw.integers(0, 256, (3 + i, 40 - i, 3), dtype=np.uint8)) for i in range(4)]
    images = stored_images(spark, named)
    measures = vision.colour_measures(images)
    found = {r.origin: r for r in measures.collect()}
    final = measures._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "keys=[origin" not in final  # an image is measured within its row
    pixels = [(name, *map(int, p)) for name, rgb in named for p in rgb.reshape(-1, 3)]
    sums = vision.pixel_features(spark.createDataFrame(pixels, "filename string, r int, g int, b int")).collect()
    assert len(sums) == len(found) == 4
    for r in sums:
        assert [found[r.filename][m] for m in measures.columns[4:]] == pytest.approx([r[m] for m in measures.columns[4:]])


def test_measures_of_repeated_cut_and_nameless_images(spark):
    flat = [("twice", solid(2, 2, (10, 20, 200)))] * 2 + [(None, solid(2, 2, (1, 2, 3))), ("one", solid(2, 2, (255, 0, 0)))]
    images = stored_images(spark, flat).unionByName(spark.createDataFrame(
        [(("cut", 2, 2, 3, 16, bytearray([0, 0, 255])),), (("one_more", -1, -1, -1, -1, bytearray()),), (None,)], IMAGE))
    rows = {}
    for r in vision.handcrafted_features(images).collect():
        rows.setdefault(r.origin, []).append(r)
    assert {k: len(v) for k, v in rows.items()} == {"twice": 2, None: 2, "one": 1, "cut": 1, "one_more": 1}
    # rows that share an origin have the measures of their sum, those without one the defaults
    assert rows["twice"][0] == rows["twice"][1] and rows["twice"][0].brightness_mean == pytest.approx(
        (0.2126 * 10 + 0.7152 * 20 + 0.0722 * 200) / 255)
    assert {r.brightness_mean for r in rows[None]} == {0.5} and {r.image_width for r in rows[None]} == {0.0, 2.0}
    assert rows["one"][0].brightness_mean == pytest.approx(0.2126) and rows["one"][0].visual_entropy == pytest.approx(0, abs=1e-8)
    assert {m: rows["one_more"][0][m] for m in vision.MEASURES} == px.UNREADABLE
