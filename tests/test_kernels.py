"""Kernels against hand-computed cases and direct loops."""

import math

import numpy as np
import pytest

from tessera.functions import kernels as k

RNG = np.random.default_rng(3)


def flat(value, h=64, w=64, channels=3):
    return np.full((1, h, w, channels), value, np.uint8)


@pytest.mark.parametrize("colour,hue", [((255, 0, 0), 0), ((0, 255, 0), 60), ((0, 0, 255), 120)])
def test_pure_colours_in_hsv(colour, hue):
    image = np.broadcast_to(np.array(colour, np.uint8), (1, 64, 64, 3))
    hsv = k.to_hsv(image)
    assert k.histograms(hsv[..., 0], 180)[0, hue] == 4096
    assert k.histograms(hsv[..., 1], 256)[0, 255] == 4096
    assert k.histograms(hsv[..., 2], 256)[0, 255] == 4096


def test_grey_in_hsv():
    hsv = k.to_hsv(flat(128))
    assert [k.histograms(hsv[..., c], b)[0, v] for c, b, v in ((0, 180, 0), (1, 256, 0), (2, 256, 128))] == [4096] * 3


def test_histogram_bins():
    assert k.histograms(np.array([[[0, 0, 2]]], np.uint8), 3).tolist() == [[2, 0, 1]]


def test_colour_round_trips():
    image = RNG.integers(0, 256, (2, 20, 20, 3)).astype(np.uint8)
    assert np.abs(k.from_hsv(k.to_hsv(image)).astype(int) - image).max() <= 6
    grey = np.repeat(image[..., :1], 3, axis=-1)
    assert np.abs(k.from_lab(k.to_lab(grey)).astype(int) - grey).max() <= 2


def test_lab_of_known_colours():
    image = np.array([[[[255, 255, 255], [0, 0, 0], [255, 0, 0]]]], np.uint8)
    assert k.to_lab(image)[0, 0].tolist() == [[255, 128, 128], [0, 128, 128], [136, 208, 195]]


def test_stretch():
    assert k.stretch(np.array([[[10, 20, 30]]], np.uint8)).tolist() == [[[0, 127, 255]]]
    assert k.stretch(flat(9)[..., 0]).max() == 0


def test_centre_crop():
    image = np.arange(25).reshape(1, 5, 5, 1)
    assert k.centre_crop(image, 3, 3)[0, ..., 0].tolist() == [[6, 7, 8], [11, 12, 13], [16, 17, 18]]
    assert k.centre_crop(image, 9, 9).shape == (1, 5, 5, 1)


def _slow_rescale(signal, m):
    """One axis, by the definition: smooth, solve for the spline, evaluate by recursion."""
    n = len(signal)
    mirror = lambda i: (n - 1) - abs((n - 1) - (abs(i) % (2 * n - 2)))

    def spline(x, degree):
        if degree == 0:
            return 1.0 if -0.5 <= x < 0.5 else 0.0
        h = (degree + 1) / 2
        return ((h + x) * spline(x + 0.5, degree - 1) + (h - x) * spline(x - 0.5, degree - 1)) / degree

    sigma = max(0, (n / m - 1) / 2)
    if sigma:
        radius = int(4 * sigma + 0.5)
        w = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
        signal = [sum(w[j + radius] * signal[mirror(i + j)] for j in range(-radius, radius + 1)) / sum(w) for i in range(n)]
    system = np.zeros((n, n))
    for i in range(n):
        for j in range(-2, 3):
            system[i, mirror(i + j)] += spline(float(j), 5)
    c = np.linalg.solve(system, signal)
    out = []
    for o in range(m):
        x = (o + 0.5) * n / m - 0.5
        out.append(sum(c[mirror(j)] * spline(x - j, 5) for j in range(math.floor(x) - 2, math.floor(x) + 4)))
    return out


@pytest.mark.parametrize("n,m", [(9, 16), (16, 9), (12, 12), (7, 20)])
def test_rescale_axis_against_direct_spline(n, m):
    signal = RNG.random(n)
    assert np.allclose(k._rescale_matrix(n, m) @ signal, _slow_rescale(list(signal), m), atol=1e-9)


def test_rescale_shapes_and_values():
    assert k.rescale(flat(51, 30, 60), 64).shape == (1, 64, 64, 3)
    assert np.allclose(k.rescale(flat(51, 30, 60), 64), 0.2, atol=1e-6)
    image = RNG.integers(0, 256, (1, 40, 33, 3)).astype(np.uint8)
    scaled = k.rescale(image, 64)
    assert scaled.min() >= image.min() / 255 - 1e-6 and scaled.max() <= image.max() / 255 + 1e-6
    same = k.rescale(image[:, :33], 33)
    assert np.allclose(same, image[:, :33] / 255, atol=1e-6)


def test_fit_pads_both_sides():
    out = k.fit(np.ones((1, 30, 60, 1)), 64, 64)[0, ..., 0]
    assert (out[:16] == 0).all() and (out[48:] == 0).all() and np.allclose(out[16:48], 1)


def test_lbp_flat_and_loop():
    plane = flat(7)[..., 0]
    codes = k.lbp(k.stretch(plane), 10, 1)
    assert (codes == 1023).all() and k.histograms(codes, 1024)[0, 1023] == 4096
    image = RNG.integers(0, 256, (1, 6, 7)).astype(np.uint8)
    codes, near = k.lbp(image, 8, 1), k.lbp(image, 8, 1, uniform=True)

    def value(y, x):
        return float(image[0, y, x]) if 0 <= y < 6 and 0 <= x < 7 else 0.0

    for y in range(6):
        for x in range(7):
            bits = []
            for i in range(8):
                dy, dx = round(-math.sin(math.pi * i / 4), 5), round(math.cos(math.pi * i / 4), 5)
                y0, x0 = math.floor(y + dy), math.floor(x + dx)
                fy, fx = dy - math.floor(dy), dx - math.floor(dx)
                top = (1 - fx) * value(y0, x0) + fx * value(y0, x0 + 1)
                low = (1 - fx) * value(y0 + 1, x0) + fx * value(y0 + 1, x0 + 1)
                bits.append(int((1 - fy) * top + fy * low >= value(y, x)))
            assert codes[0, y, x] == sum(b << i for i, b in enumerate(bits))
            changes = sum(bits[i] != bits[i + 1] for i in range(7))
            assert near[0, y, x] == (sum(bits) if changes <= 2 else 9)


def test_hog_length_and_flat():
    assert k.hog(flat(90), 9, 6, 2).shape == (1, 2916)
    assert not k.hog(flat(90), 9, 6, 2).any()
    ramp = np.tile(np.arange(64, dtype=np.uint8)[None, None, :, None], (1, 64, 1, 3))
    blocks = k.hog(ramp, 9, 6, 2).reshape(81, 4, 9)
    assert (blocks[..., 0] > 0).all() and not blocks[..., 1:].any()  # left to right: angle 0
    assert np.allclose((blocks.reshape(81, -1) ** 2).sum(axis=1), 1, atol=1e-3)


def test_template_map_centre_is_one():
    image = RNG.integers(0, 256, (1, 64, 64)).astype(np.uint8)
    other = RNG.integers(0, 256, (1, 64, 64)).astype(np.uint8)
    scores = k.template_map(image, np.concatenate([image, other]), 4)[0]
    assert scores.shape == (162,) and scores[40] == pytest.approx(1, abs=1e-6)
    assert np.abs(scores).max() <= 1 + 1e-6 and scores[:81].argmax() == 40
    assert not k.template_map(flat(0)[..., 0], image, 4).any()


def test_exact_correlation():
    a, b = RNG.integers(0, 256, (5, 64)), RNG.integers(0, 256, (3, 64))
    found = k.exact_correlation(a, b)
    assert np.allclose(found, [[np.corrcoef(x, y)[0, 1] for y in b] for x in a])
    assert not k.exact_correlation(np.ones((1, 8), int), b[:, :8]).any()


def test_edges_of_a_square():
    image = np.zeros((1, 20, 20), np.uint8)
    image[:, 6:14, 6:14] = 200
    found = k.edge_map(image)[0]
    assert set(np.unique(found)) <= {0, 75, 255}
    assert (found[10] == 255).sum() >= 2 and found[10, 10] == 0 and found[1, 1] == 0
    assert not k.edge_map(flat(5)[..., 0]).any()


def test_hysteresis_runs_in_reading_order():
    """A weak chain beside one strong pixel is taken up along the reading direction."""

    def slow(plane):
        strength, angle = k.sobel(k.blur(plane, 1.0, 2, "symmetric"))
        thin = k.thin_edges(strength, angle)[0]
        upper = thin.max() * 0.15
        out = np.where(thin >= upper, 255, 0)
        out = np.where((thin <= upper) & (thin >= upper * 0.05), 75, out)
        for y in range(1, out.shape[0] - 1):
            for x in range(1, out.shape[1] - 1):
                if out[y, x] == 75:
                    out[y, x] = 255 if (out[y - 1 : y + 2, x - 1 : x + 2] == 255).any() else 0
        return out

    stack = RNG.integers(0, 256, (4, 12, 15)).astype(np.uint8)
    assert (k.edge_map(stack) == np.array([slow(p[None]) for p in stack])).all()


def test_equalise_against_loop():
    plane = RNG.integers(30, 90, (2, 9, 9)).astype(np.uint8)
    found = k.equalise(plane)
    for image, out in zip(plane, found):
        low = (image == image.min()).sum()
        for v in np.unique(image):
            want = round(float((image <= v).sum() - low) * 255 / (81 - low))
            assert abs(int(out[image == v][0]) - want) <= 1
    assert (k.equalise(flat(7)[..., 0]) == 7).all()


def test_clahe_keeps_shape_and_range():
    plane = RNG.integers(100, 140, (2, 30, 41)).astype(np.uint8)
    out = k.clahe(plane, 3.0)
    assert out.shape == plane.shape and out.std() > plane.std()
    assert k.clahe(flat(60)[..., 0], 3.0).shape == (1, 64, 64)


def test_blur_keeps_constants():
    assert np.allclose(k.blur(flat(40), 2.0), 40)
