"""Small NumPy kernels that run inside Arrow batches.

Each takes a stack of equally sized images, (n, height, width[, channels]), so one call
serves a whole batch. Spark does the reading, partitioning and shuffling around them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# BT.601 luma weights over 32768.
LUMA_15 = (9798, 19235, 3735)
# Linear sRGB to XYZ under D65, rows X, Y, Z, and the white point.
RGB_TO_XYZ = np.array(
    [[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]
)
WHITE = np.array([0.950456, 1.0, 1.088754])


def to_bytes(image: np.ndarray) -> np.ndarray:
    """0..1 to 0..255, cut off; bytes stay as they are."""
    return image if image.dtype == np.uint8 else (image * np.float32(255.0)).astype(np.uint8)


def to_unit(image: np.ndarray) -> np.ndarray:
    return image / 255.0 if image.dtype == np.uint8 else image.astype(np.float64)


# ---- size ---------------------------------------------------------------------------------


def centre_crop(image: np.ndarray, height: int, width: int) -> np.ndarray:
    top = max(0, (image.shape[1] - height) // 2)
    left = max(0, (image.shape[2] - width) // 2)
    return image[:, top : top + height, left : left + width]


def _mirror(index: np.ndarray, n: int) -> np.ndarray:
    """Positions outside 0..n-1 reflected about the edge pixels."""
    if n == 1:
        return np.zeros_like(index)
    index = np.abs(index) % (2 * n - 2)
    return np.where(index >= n, 2 * n - 2 - index, index)


def _quintic(x: np.ndarray) -> np.ndarray:
    """Centred B-spline of degree 5 (sum of truncated powers)."""
    binomial = [1, 6, 15, 20, 15, 6, 1]
    return sum((-1) ** k * c * np.maximum(x + 3 - k, 0) ** 5 for k, c in enumerate(binomial)) / 120


def _gauss(sigma: float, radius: int) -> np.ndarray:
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return weights / weights.sum()


@lru_cache(maxsize=256)
def _rescale_matrix(n: int, m: int) -> np.ndarray:
    """One axis of the rescaling as an (m, n) matrix: smooth, spline coefficients, sample."""
    rows = np.arange(n)
    smooth = np.eye(n)
    sigma = max(0.0, (n / m - 1) / 2)
    if sigma > 0:
        radius = int(4 * sigma + 0.5)
        smooth = np.zeros((n, n))
        for shift, weight in zip(range(-radius, radius + 1), _gauss(sigma, radius)):
            np.add.at(smooth, (rows, _mirror(rows + shift, n)), weight)
    knots = np.zeros((n, n))
    for shift in range(-2, 3):
        np.add.at(knots, (rows, _mirror(rows + shift, n)), _quintic(np.array(float(shift))))
    at = (np.arange(m) + 0.5) * (n / m) - 0.5
    sample = np.zeros((m, n))
    for shift in range(-2, 4):
        k = np.floor(at).astype(int) + shift
        np.add.at(sample, (np.arange(m), _mirror(k, n)), _quintic(at - k))
    return sample @ np.linalg.solve(knots, smooth)


def rescale(image: np.ndarray, size: int) -> np.ndarray:
    """Shorter side to size with a degree-5 spline, then the central size x size part; floats 0..1."""
    unit = to_unit(image)
    _, h, w, _ = unit.shape
    scale = size / min(h, w)
    rows, cols = (_rescale_matrix(n, max(1, round(scale * n))) for n in (h, w))
    flat = tuple(range(1, 4))
    lo, hi = unit.min(axis=flat, keepdims=True), unit.max(axis=flat, keepdims=True)
    big = np.clip(np.einsum("ah,nhwc,bw->nabc", rows, unit, cols, optimize=True), lo, hi)
    top, left = (int(n / 2 - size / 2) for n in big.shape[1:3])
    return big[:, top : top + size, left : left + size].astype(np.float32)


def resize_bilinear(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear with half-pixel centres and no smoothing."""

    def axis(n: int, m: int) -> np.ndarray:
        at = (np.arange(m) + 0.5) * (n / m) - 0.5
        low, out = np.floor(at).astype(int), np.zeros((m, n))
        np.add.at(out, (np.arange(m), np.clip(low, 0, n - 1)), 1 - (at - low))
        np.add.at(out, (np.arange(m), np.clip(low + 1, 0, n - 1)), at - low)
        return out

    rows, cols = axis(image.shape[1], height), axis(image.shape[2], width)
    return np.einsum("ah,nhwc,bw->nabc", rows, image.astype(np.float64), cols, optimize=True)


def fit(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Keep the shape, resize to fit, zeros around it (odd pixel on top and left)."""
    _, h, w, _ = image.shape
    scale = min(height / h, width / w)
    small = resize_bilinear(image, max(1, round(h * scale)), max(1, round(w * scale)))
    gap_y, gap_x = height - small.shape[1], width - small.shape[2]
    sides = ((0, 0), (gap_y - gap_y // 2, gap_y // 2), (gap_x - gap_x // 2, gap_x // 2), (0, 0))
    return np.pad(small, sides)


# ---- colour -------------------------------------------------------------------------------


def grey(rgb: np.ndarray) -> np.ndarray:
    return ((to_bytes(rgb).astype(np.int64) @ np.array(LUMA_15) + 16384) >> 15).astype(np.uint8)


def to_hsv(rgb: np.ndarray) -> np.ndarray:
    """8-bit HSV, hue 0..179, in 12-bit fixed point."""
    r, g, b = np.moveaxis(to_bytes(rgb).astype(np.int64), -1, 0)
    v = np.maximum(np.maximum(r, g), b)
    d = v - np.minimum(np.minimum(r, g), b)
    s_step = np.where(v > 0, np.rint(255 * 4096 / np.maximum(v, 1)), 0).astype(np.int64)
    h_step = np.where(d > 0, np.rint(180 * 4096 / (6.0 * np.maximum(d, 1))), 0).astype(np.int64)
    turn = np.where(v == r, g - b, np.where(v == g, b - r + 2 * d, r - g + 4 * d))
    hue = (turn * h_step + 2048) >> 12
    return np.stack([np.where(hue < 0, hue + 180, hue), (d * s_step + 2048) >> 12, v], -1).astype(np.uint8)


def from_hsv(hsv: np.ndarray) -> np.ndarray:
    h, s, v = np.moveaxis(hsv.astype(np.float64), -1, 0)
    h, s, v = h / 30.0, s / 255.0, v / 255.0
    offset = np.array([5.0, 3.0, 1.0])  # of red, green, blue on the colour wheel
    k = (offset + h[..., None]) % 6
    unit = v[..., None] * (1 - s[..., None] * np.clip(np.minimum(k, 4 - k), 0, 1))
    return np.rint(unit * 255).astype(np.uint8)


def to_lab(rgb: np.ndarray) -> np.ndarray:
    """8-bit LAB: L over 0..255, a and b around 128."""
    unit = np.arange(256) / 255.0
    linear = np.where(unit > 0.04045, ((unit + 0.055) / 1.055) ** 2.4, unit / 12.92)[to_bytes(rgb)]
    xyz = linear @ RGB_TO_XYZ.T / WHITE
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    light = np.where(xyz[..., 1] > 0.008856, 116 * f[..., 1] - 16, 903.3 * xyz[..., 1])
    a, b = 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128
    return np.clip(np.rint(np.stack([light * 2.55, a, b], -1)), 0, 255).astype(np.uint8)


def from_lab(lab: np.ndarray) -> np.ndarray:
    light, a, b = np.moveaxis(lab.astype(np.float64), -1, 0)
    fy = (light / 2.55 + 16) / 116
    f = np.stack([fy + (a - 128) / 500, fy, fy - (b - 128) / 200], -1)
    xyz = np.where(f > 6 / 29, f**3, (f - 16 / 116) / 7.787) * WHITE
    linear = np.clip(xyz @ np.linalg.inv(RGB_TO_XYZ).T, 0, 1)
    unit = np.where(linear > 0.0031308, 1.055 * linear ** (1 / 2.4) - 0.055, 12.92 * linear)
    return np.rint(unit * 255).astype(np.uint8)


def stretch(plane: np.ndarray, top: int = 255) -> np.ndarray:
    """Spread min..max of each plane over 0..top, cut off; a flat plane becomes 0."""
    lo, hi = (f(axis=(1, 2), keepdims=True).astype(np.float64) for f in (plane.min, plane.max))
    slope = top / np.where(hi > lo, hi - lo, 1)
    spread = np.where(plane == hi, top, (plane - lo) * slope)
    return np.where(hi > lo, spread, 0).astype(np.uint8)


def histograms(plane: np.ndarray, bins: int) -> np.ndarray:
    """Counts per level for each plane of the stack."""
    n = len(plane)
    shifted = plane.reshape(n, -1).astype(np.int64) + np.arange(n)[:, None] * bins
    return np.bincount(shifted.ravel(), minlength=n * bins).reshape(n, bins)


def equalise(plane: np.ndarray) -> np.ndarray:
    """Grey levels through the plane's own cumulative distribution."""
    hist = histograms(plane, 256)
    below = hist.cumsum(axis=1)
    rows = np.arange(len(plane))
    low = (hist > 0).argmax(axis=1)
    first, pixels = hist[rows, low][:, None], below[:, -1:]
    scale = np.float32(255) / np.maximum(pixels - first, 1).astype(np.float32)
    table = np.rint((np.maximum(below - first, 0)).astype(np.float32) * scale)
    flat = (pixels == first) * np.arange(256) + (pixels != first) * table
    return flat.astype(np.uint8)[rows[:, None, None], plane]


def clahe(plane: np.ndarray, clip: float, tiles: int = 8) -> np.ndarray:
    """Equalise per tile with a clipped histogram, blended between the tile centres."""
    n, h, w = plane.shape
    whole = h % tiles == 0 and w % tiles == 0
    gap_y, gap_x = (0, 0) if whole else (tiles - h % tiles, tiles - w % tiles)
    full = np.pad(plane, ((0, 0), (0, gap_y), (0, gap_x)), mode="reflect")
    th, tw = full.shape[1] // tiles, full.shape[2] // tiles
    cells = full.reshape(n, tiles, th, tiles, tw).transpose(0, 1, 3, 2, 4).reshape(-1, th, tw)
    hist = histograms(cells, 256)
    limit = max(int(clip * th * tw / 256), 1)
    spare = np.maximum(hist - limit, 0).sum(axis=1)
    hist = np.minimum(hist, limit) + (spare // 256)[:, None]
    left = spare % 256
    step = np.maximum(256 // np.maximum(left, 1), 1)[:, None]
    level = np.arange(256)
    hist += (level % step == 0) & (level // step < left[:, None])
    lut = np.rint(hist.cumsum(axis=1) * np.float32(255 / (th * tw))).clip(0, 255).reshape(n, tiles, tiles, 256)

    def axis(size: int, tile: int):
        at = np.arange(size) / tile - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, tiles - 1), np.clip(low + 1, 0, tiles - 1), at - low

    y0, y1, fy = axis(h, th)
    x0, x1, fx = axis(w, tw)
    image = np.arange(n)[:, None, None]
    pick = lambda y, x: lut[image, y[None, :, None], x[None, None, :], plane]
    fy = fy[None, :, None]
    upper = pick(y0, x0) * (1 - fx) + pick(y0, x1) * fx
    lower = pick(y1, x0) * (1 - fx) + pick(y1, x1) * fx
    return np.rint(upper * (1 - fy) + lower * fy).clip(0, 255).astype(np.uint8)


# ---- texture, gradients, templates -----------------------------------------------------------


def lbp(plane: np.ndarray, points: int, radius: float, uniform: bool = False) -> np.ndarray:
    """Local binary pattern: bit i is set where the i-th circle point is not darker than the centre.

    Circle points between pixels are bilinear; outside the image the value is 0.
    """
    grey_levels = plane.astype(np.float64)
    _, h, w = plane.shape
    turn = 2 * np.pi * np.arange(points) / points
    margin = int(np.ceil(radius)) + 1
    padded = np.pad(grey_levels, ((0, 0), (margin, margin), (margin, margin)))
    bits = []
    for dy, dx in zip(np.round(-radius * np.sin(turn), 5), np.round(radius * np.cos(turn), 5)):
        y, x = int(np.floor(dy)), int(np.floor(dx))
        fy, fx = dy - y, dx - x
        part = lambda a, b: padded[:, margin + a : margin + a + h, margin + b : margin + b + w]
        up = (1 - fx) * part(y, x) + fx * part(y, x + 1)
        down = (1 - fx) * part(y + 1, x) + fx * part(y + 1, x + 1)
        bits.append((1 - fy) * up + fy * down - grey_levels >= 0)
    signs = np.stack(bits).astype(np.int16)
    if uniform:
        changes = np.abs(np.diff(signs, axis=0)).sum(axis=0)
        return np.where(changes <= 2, signs.sum(axis=0), points + 1).astype(np.int16)
    return np.tensordot(1 << np.arange(points), signs, 1).astype(np.int16)


def hog(image: np.ndarray, orientations: int, cell: int, block: int) -> np.ndarray:
    """Oriented gradients: strongest channel, hard bins, cell means, clipped L2 per block.

    Differences of bytes are whole numbers, so equal ones have one angle. An angle counts from
    the bin edge it is on, also where it is off by a last digit.
    """
    levels = image.astype(np.float64)
    gy, gx = np.zeros_like(levels), np.zeros_like(levels)
    gy[:, 1:-1] = levels[:, 2:] - levels[:, :-2]
    gx[:, :, 1:-1] = levels[:, :, 2:] - levels[:, :, :-2]
    strength = np.hypot(gx, gy) / (255 if image.dtype == np.uint8 else 1)
    best = strength.argmax(axis=-1)[..., None]
    gy, gx, strength = (np.take_along_axis(a, best, -1)[..., 0] for a in (gy, gx, strength))
    angle = np.rad2deg(np.arctan2(gy, gx)) % 180
    n, h, w = strength.shape
    rows, cols = h // cell, w // cell
    inside = (slice(None), slice(rows * cell), slice(cols * cell))
    bins = np.floor(angle / (180 / orientations) + 1e-9).astype(int)[inside] % orientations
    weight = strength[inside]
    image, y, x = (np.arange(m) for m in (n, rows * cell, cols * cell))
    place = (image[:, None, None] * rows + (y // cell)[:, None]) * cols + x // cell
    slot = place * orientations + bins
    cells = np.bincount(slot.ravel(), weight.ravel(), n * rows * cols * orientations)
    cells = cells.reshape(n, rows, cols, orientations) / cell**2
    view = np.lib.stride_tricks.sliding_window_view(cells, (block, block), axis=(1, 2))
    blocks = view.transpose(0, 1, 2, 4, 5, 3)  # image, block row, block col, cell row, cell col, bin
    length = lambda b: np.sqrt((b**2).sum(axis=(3, 4, 5), keepdims=True) + 1e-10)
    blocks = np.minimum(blocks / length(blocks), 0.2)
    return (blocks / length(blocks)).reshape(n, -1).astype(np.float32)


def template_map(plane: np.ndarray, templates: np.ndarray, margin: int) -> np.ndarray:
    """Normalised correlation of each template at all offsets up to margin, zeros around the image."""
    n, (t, th, tw) = len(plane), templates.shape
    padded = np.pad(plane.astype(np.float64), ((0, 0), (margin, margin), (margin, margin)))
    flat = templates.reshape(t, -1).astype(np.float64)
    flat = flat - flat.mean(axis=1, keepdims=True)
    spread = np.sqrt((flat**2).sum(axis=1))
    out = []
    for image in padded:  # one image at a time keeps the window matrix small
        windows = np.lib.stride_tricks.sliding_window_view(image, (th, tw)).reshape(-1, th * tw)
        total, squares = windows.sum(axis=1), np.einsum("ij,ij->i", windows, windows)  # whole numbers, exact
        scale = np.sqrt(squares - total * total / (th * tw))[:, None] * spread[None, :]
        # the templates sum to zero, so the mean of a window drops out of the product
        scores = windows @ flat.T / np.where(scale > 1e-6, scale, np.inf)
        out.append(scores.T.ravel())  # template by template, offsets row by row
    return np.array(out, dtype=np.float32).reshape(n, -1)


def similarity_map(plane: np.ndarray, template: np.ndarray, threshold: int = -1) -> np.ndarray:
    """Per pixel, sum of (1 - |difference| / 255) squared over the centred template pixels above the threshold."""
    _, h, w = plane.shape
    th, tw = template.shape
    cy, cx = (th - 1) // 2, (tw - 1) // 2
    out = np.zeros(plane.shape)
    for y, x in np.argwhere(template > threshold):
        dy, dx = y - cy, x - cx  # image pixel (row + dy, col + dx) meets this template pixel
        rows, cols = slice(max(0, -dy), min(h, h - dy)), slice(max(0, -dx), min(w, w - dx))
        seen = plane[:, rows.start + dy : max(rows.stop, rows.start) + dy, cols.start + dx : max(cols.stop, cols.start) + dx]
        near = 1.0 - np.abs(seen.astype(np.float64) - float(template[y, x])) / 255.0
        out[:, rows, cols] += near * near
    return out


def exact_correlation(planes: np.ndarray, templates: np.ndarray) -> np.ndarray:
    """Correlation of integer rows from exact sums (whole numbers below 2**53 in doubles)."""
    a, b, n = planes.astype(np.float64), templates.astype(np.float64), planes.shape[1]
    sa, sb = a.sum(axis=1)[:, None], b.sum(axis=1)[None, :]
    spread = np.sqrt(n * (a * a).sum(axis=1)[:, None] - sa * sa) * np.sqrt(n * (b * b).sum(axis=1)[None, :] - sb * sb)
    return np.where(spread > 0, (n * (a @ b.T) - sa * sb) / np.where(spread > 0, spread, 1), 0.0)


def blur(image: np.ndarray, sigma: float, radius: int | None = None, border: str = "edge") -> np.ndarray:
    """Gaussian along height and width; by default the border repeats its edge pixel."""
    radius = int(4 * sigma + 0.5) if radius is None else radius
    weights = _gauss(sigma, radius)
    out = image.astype(np.float64)
    for axis in (1, 2):
        sides = [(0, 0)] * out.ndim
        sides[axis] = (radius, radius)
        view = np.lib.stride_tricks.sliding_window_view(np.pad(out, sides, mode=border), 2 * radius + 1, axis=axis)
        out = view @ weights
    return out


def sobel(plane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient strength (largest = 255) and angle of each plane."""
    p = np.pad(plane.astype(np.float64), ((0, 0), (1, 1), (1, 1)), mode="symmetric")
    column = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    line = p[:, :, :-2] + 2 * p[:, :, 1:-1] + p[:, :, 2:]
    gx, gy = column[:, :, :-2] - column[:, :, 2:], line[:, 2:] - line[:, :-2]
    strength = np.hypot(gx, gy)
    top = strength.max(axis=(1, 2), keepdims=True)
    return strength / np.where(top > 0, top, 1) * 255, np.arctan2(gy, gx)


def thin_edges(strength: np.ndarray, angle: np.ndarray) -> np.ndarray:
    """Keep a pixel when neither neighbour across its edge is stronger; the frame is 0."""
    degrees = np.rad2deg(angle)
    degrees = np.where(degrees < 0, degrees + 180, degrees)
    sector = np.floor((degrees + 22.5) / 45).astype(int) % 4
    padded = np.pad(strength, ((0, 0), (1, 1), (1, 1)))
    h, w = strength.shape[1:]
    near = lambda dy, dx: padded[:, 1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
    ahead = np.choose(sector, [near(0, 1), near(1, -1), near(1, 0), near(-1, -1)])
    behind = np.choose(sector, [near(0, -1), near(-1, 1), near(-1, 0), near(1, 1)])
    kept = np.where((strength >= ahead) & (strength >= behind), strength, 0).astype(np.int32)
    framed = np.zeros_like(kept)
    framed[:, 1:-1, 1:-1] = kept[:, 1:-1, 1:-1]
    return framed


# The default settings of the edge map.
def edge_map(
    plane: np.ndarray,
    sigma: float = 1.0,
    size: int = 5,
    low: float = 0.05,
    high: float = 0.15,
    weak: int = 75,
    strong: int = 255,
) -> np.ndarray:
    """Blur, gradient, thinning, two thresholds, then one pass that keeps weak pixels beside strong ones."""
    thin = thin_edges(*sobel(blur(plane, sigma, size // 2, "symmetric")))
    upper = thin.max(axis=(1, 2), keepdims=True) * high
    lower = upper * low
    out = np.where(thin >= upper, strong, 0)
    out = np.where((thin <= upper) & (thin >= lower), weak, out)
    return np.where(upper > 0, _keep_touching(out, weak, strong), 0)  # a flat image has no edges


def _keep_touching(marks: np.ndarray, weak: int, strong: int) -> np.ndarray:
    """One pass in reading order over the inner pixels: weak ones beside a strong one become strong, others 0.

    A pixel taken up counts for the next ones, so within a line it carries on along the
    run of weak pixels to its right; lines are done one after the other.
    """
    hit, open_ = marks == strong, np.zeros(marks.shape, bool)
    open_[:, 1:-1, 1:-1] = marks[:, 1:-1, 1:-1] == weak
    column = np.arange(marks.shape[2])
    for y in range(1, marks.shape[1] - 1):
        near = np.pad(hit[:, y - 1] | hit[:, y + 1], ((0, 0), (1, 1)))
        own = np.pad(hit[:, y], ((0, 0), (1, 1)))
        beside = near[:, :-2] | near[:, 1:-1] | near[:, 2:] | own[:, :-2] | own[:, 2:]
        line = open_[:, y]
        start = np.maximum.accumulate(np.where(line & beside, column, -1), axis=1)
        stop = np.maximum.accumulate(np.where(line, -1, column), axis=1)
        hit[:, y] |= line & (start > stop)
    return np.where(hit, strong, np.where(open_, 0, marks))
