"""Pixel operators: identities, brute force, known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.functions import pixels as P
from fieldlake.operators import images as IM
from fieldlake.schemas import IMAGE


def images(spark, *arrays):
    rows = []
    for i, a in enumerate(arrays):
        h, w, c = a.shape
        rows.append((i, "A", (f"o{i}", h, w, c, 16, bytearray(a.astype(np.uint8).tobytes()))))
    return spark.createDataFrame(rows, f"image_id int, class_label string, image {IMAGE.simpleString()}").coalesce(1)


def arrays(df):
    return [np.frombuffer(bytes(r.data), np.uint8).reshape(r.height, r.width, r.nChannels)
            for (r,) in df.orderBy("image_id").select("image").collect()]


@pytest.fixture
def noise():
    rng = np.random.default_rng(7)
    return [rng.integers(0, 256, shape) for shape in ((5, 4, 3), (6, 9, 1), (3, 3, 4))]


def test_double_flip_is_identity_and_single_flip_mirrors(spark, noise):
    df = images(spark, *noise)
    for a, h, v in zip(noise, arrays(IM.flip_horizontal(df)), arrays(IM.flip_vertical(df))):
        assert (h == a[:, ::-1]).all() and (v == a[::-1]).all()
    for flip in (IM.flip_horizontal, IM.flip_vertical):
        assert all((x == a).all() for x, a in zip(arrays(flip(flip(df))), noise))


def test_normalise_round_trip_is_exact_for_all_levels(spark):
    levels = np.arange(256).reshape(16, 16, 1)
    df = IM.denormalised(IM.normalised(images(spark, levels)))
    assert bytes(df.first()["data"]) == bytes(range(256))


def test_stats_against_numpy(spark, noise):
    got = IM.channel_stats(IM.pixel_stats(images(spark, noise[0]), digits=9), digits=9).first()
    a = noise[0]
    assert got["pixel_mean"] == pytest.approx(a.mean(), abs=1e-8)
    assert got["pixel_std"] == pytest.approx(a.std(), abs=1e-8)
    assert (got["pixel_min"], got["pixel_max"]) == (a.min(), a.max())
    assert got["red_mean"] == pytest.approx(a[:, :, 2].mean(), abs=1e-8)
    assert got["blue_std"] == pytest.approx(a[:, :, 0].std(), abs=1e-8)


def test_flat_image_has_zero_deviation(spark):
    assert IM.pixel_stats(images(spark, np.full((30, 30, 3), 201))).first()["pixel_std"] == 0.0


def test_to_rgb_drops_alpha_and_repeats_gray(spark, noise):
    rows = IM.to_rgb(images(spark, *noise)).orderBy("image_id").collect()
    wanted = [noise[0][:, :, ::-1], np.repeat(noise[1], 3, axis=2), noise[2][:, :, [2, 1, 0]]]
    assert [bytes(r["rgb"]) for r in rows] == [w.astype(np.uint8).tobytes() for w in wanted]


def test_brightness_clips_and_truncates(spark):
    a = np.array([[[0], [99], [200], [255]]])
    assert arrays(IM.brightness(images(spark, a), F.lit(1.2)))[0].ravel().tolist() == [0, 118, 240, 255]


def test_rotation(spark, noise):
    same = arrays(IM.rotate(images(spark, *noise), F.lit(0.0)))
    assert all((x == a).all() for x, a in zip(same, noise))
    square = np.arange(16).reshape(4, 4, 1)
    assert (arrays(IM.rotate(images(spark, square), F.lit(90.0)))[0] == np.rot90(square)).all()
    turned = arrays(IM.rotate(images(spark, np.full((20, 20, 1), 255)), F.lit(15.0)))[0]
    assert turned[0, 0, 0] == 0 and turned[10, 10, 0] == 255


def test_resize_keeps_flat_images_and_same_size(spark, noise):
    flat = np.full((11, 7, 3), 93)
    assert (arrays(IM.resize(images(spark, flat), 5, 16))[0] == 93).all()
    assert (arrays(IM.resize(images(spark, noise[0]), 5, 4))[0] == noise[0]).all()


def test_resize_weights_sum_to_one_and_ramp_stays_ordered(spark):
    weights = P._lanczos_weights(100, 30)
    assert weights.shape == (30, 100) and np.allclose(weights.sum(axis=1), 1)
    ramp = np.tile(np.linspace(20, 230, 64)[None, :, None], (4, 1, 1))
    small = arrays(IM.resize(images(spark, ramp), 4, 16))[0][0, :, 0].astype(int)
    assert (np.diff(small) > 0).all()


def test_histogram_counts_every_pixel_once(spark, noise):
    a = noise[0]
    got = {(r["channel"], r["bin"]): r["n_pixels"] for r in IM.colour_histogram(images(spark, a)).collect()}
    for c in range(3):
        wanted = np.bincount(a[:, :, c].ravel() // 32, minlength=8).tolist()
        assert [got[c, b] for b in range(8)] == wanted
