"""Raster primitives and tile descriptors in NumPy: masks, morphology, filters, resizing and 42 features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from siftwell.config import PatchOptions
from siftwell.schemas import BASE_FEATURES

# fixed values: optical densities of hematoxylin and DAB (Ruifrok and Johnston, 2001)
HEMATOXYLIN = (0.650, 0.704, 0.286)
DAB = (0.268, 0.570, 0.776)
_BASIS = np.array([HEMATOXYLIN, DAB], np.float32).T
_UNMIX = np.linalg.pinv(_BASIS).astype(np.float32)


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """4-connected components: (labels from 1, number of components)."""
    mask = np.asarray(mask, bool)
    out = np.zeros(mask.shape, np.int64)
    if not mask.any():
        return out, 0
    flat = np.pad(mask, ((0, 0), (1, 1)))
    step = np.diff(flat.astype(np.int8), axis=1)
    row, start = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    n = len(row)
    root = np.arange(n)
    heads = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    pairs = []
    for r in range(1, mask.shape[0]):
        a, b = slice(heads[r - 1], heads[r]), slice(heads[r], heads[r + 1])
        if a.start < a.stop and b.start < b.stop:
            # runs of the row above that overlap each run of this row
            low = np.searchsorted(end[a], start[b], side="right") + a.start
            high = np.searchsorted(start[a], end[b], side="left") + a.start
            width = np.maximum(high - low, 0)
            mine = np.repeat(np.arange(b.start, b.stop), width)
            theirs = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low, width)
            pairs.append(np.stack([mine, theirs]))
    if pairs:
        i, j = np.concatenate(pairs, axis=1)
        while len(i):
            least = np.minimum(root[i], root[j])
            old_i, old_j = root[i], root[j]
            for at in (i, j, old_i, old_j):
                np.minimum.at(root, at, least)
            while not np.array_equal(root[root], root):
                root = root[root]
            open_ = root[i] != root[j]
            i, j = i[open_], j[open_]
    _, names = np.unique(root, return_inverse=True)
    marks = np.zeros(mask.shape[0] * mask.shape[1], np.int64)
    lengths = end - start
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(row * mask.shape[1] + start, lengths)
    marks[at] = np.repeat(names + 1, lengths)
    return marks.reshape(mask.shape), int(names.max()) + 1


def areas(mask: np.ndarray) -> np.ndarray:
    """Pixel counts of the components."""
    labels, n = label(mask)
    return np.bincount(labels.ravel(), minlength=n + 1)[1:].astype(np.float32)


def drop_small(mask: np.ndarray, least: int) -> np.ndarray:
    """``mask`` without components of fewer than ``least`` pixels."""
    labels, n = label(mask)
    big = np.bincount(labels.ravel(), minlength=n + 1) >= least
    big[0] = False
    return big[labels]


def _shifted(mask: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """``mask`` moved by (dy, dx); what enters is False."""
    out = np.zeros_like(mask)
    h, w = mask.shape
    out[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] = mask[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
    return out


def _disk(radius: int) -> list[tuple[int, int]]:
    span = range(-radius, radius + 1)
    return [(y, x) for y in span for x in span if y * y + x * x <= radius * radius]


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    """Union of the mask moved over a disk."""
    out = np.zeros_like(mask)
    for dy, dx in _disk(radius):
        if abs(dy) < mask.shape[0] and abs(dx) < mask.shape[1]:
            out |= _shifted(mask, dy, dx)
    return out


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    """Pixels whose whole disk lies in the mask; outside counts as unset."""
    out = np.ones_like(mask)
    for dy, dx in _disk(radius):
        out &= _shifted(mask, dy, dx) if abs(dy) < mask.shape[0] and abs(dx) < mask.shape[1] else False
    return out


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """``mask`` with background that does not reach the border filled."""
    labels, n = label(~mask)
    outside = np.zeros(n + 1, bool)
    for edge in (labels[0], labels[-1], labels[:, 0], labels[:, -1]):
        outside[edge] = True
    return mask | ((labels > 0) & ~outside[labels])


def _reflected(x: np.ndarray, pad: int) -> np.ndarray:
    return np.pad(x, pad, mode="symmetric")


def box_mean(x: np.ndarray, size: int) -> np.ndarray:
    """Mean over a square window with mirrored edges."""
    pad = size // 2
    sums = np.pad(_reflected(x, pad).astype(np.float64).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h, w = x.shape
    total = sums[size : size + h, size : size + w] - sums[:h, size : size + w] - sums[size : size + h, :w] + sums[:h, :w]
    return (total / size**2).astype(np.float32)


def local_std(x: np.ndarray, size: int = 7) -> np.ndarray:
    """Standard deviation over a square window."""
    m = box_mean(x, size)
    return np.sqrt(np.maximum(box_mean(x * x, size) - m * m, 0))


def gradient(x: np.ndarray) -> np.ndarray:
    """Sobel magnitude with mirrored edges."""
    p = _reflected(x, 1)
    smooth = lambda a: a[:-2] + 2 * a[1:-1] + a[2:]
    gy = smooth((p[2:, :] - p[:-2, :]).T).T
    gx = smooth(p[:, 2:] - p[:, :-2])
    return np.hypot(gy, gx)


def laplace(x: np.ndarray) -> np.ndarray:
    """Sum of second differences with mirrored edges."""
    p = _reflected(x, 1)
    return p[2:, 1:-1] + p[:-2, 1:-1] + p[1:-1, 2:] + p[1:-1, :-2] - 4 * x


def _weights(size: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Triangle-filter taps of every target pixel, widened when shrinking: (first source pixel, weights)."""
    scale = size / target
    reach = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    low = np.maximum((centre - reach + 0.5).astype(int), 0)
    taps = int(np.ceil(reach)) * 2 + 1
    at = low[:, None] + np.arange(taps)
    w = np.maximum(1 - np.abs((at + 0.5 - centre[:, None]) / reach), 0)
    high = np.minimum((centre + reach + 0.5).astype(int), size)
    w[at >= high[:, None]] = 0
    return np.minimum(at, size - 1), w / w.sum(axis=1, keepdims=True)


def resize(rgb: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear resizing of 8-bit images, smoothed when shrinking; rows first, rounded after each pass."""
    out = rgb
    for axis, target in ((1, width), (0, height)):
        if out.shape[axis] != target:
            at, w = _weights(out.shape[axis], target)
            moved = np.moveaxis(out, axis, 0).astype(np.float64)
            mixed = sum(moved[at[:, k]] * w[:, k].reshape(-1, *[1] * (moved.ndim - 1)) for k in range(at.shape[1]))
            out = np.moveaxis(np.clip(np.floor(mixed + 0.5), 0, 255).astype(np.uint8), 0, axis)
    return out


def resize_mask(mask: np.ndarray, width: int, height: int) -> np.ndarray:
    """Nearest resizing of a mask."""
    rows = np.minimum(((np.arange(height) + 0.5) * mask.shape[0] / height).astype(int), mask.shape[0] - 1)
    cols = np.minimum(((np.arange(width) + 0.5) * mask.shape[1] / width).astype(int), mask.shape[1] - 1)
    return mask[rows][:, cols].astype(bool)


def decode_rle(text, height: int, width: int) -> np.ndarray | None:
    """A mask from ``start length`` pairs that count columns first from 1; None if it isn't one."""
    tokens = text.split() if isinstance(text, str) else []
    if not tokens or len(tokens) % 2:
        return None
    try:
        pairs = np.array(tokens, dtype=np.int64).reshape(-1, 2)
    except ValueError:
        return None
    start, end = pairs[:, 0] - 1, pairs[:, 0] - 1 + pairs[:, 1]
    if (start < 0).any() or (end > height * width).any():
        return None
    mask = np.zeros(height * width, bool)
    for a, b in zip(start, end, strict=True):
        mask[a:b] = True
    return mask.reshape(width, height).T


@dataclass
class SlideStats:
    """Reference quantiles of one image at one scale."""

    dab_q05: float
    dab_q95: float
    h_q05: float
    h_q95: float
    residual_q95: float


def _q(x: np.ndarray, p: float, default: float = 0.0) -> float:
    return float(np.quantile(x, p)) if x.size else default


def _mean(x: np.ndarray) -> float:
    return float(x.mean()) if x.size else 0.0


def _std(x: np.ndarray) -> float:
    return float(x.std()) if x.size else 0.0


def density(rgb: np.ndarray) -> np.ndarray:
    """Optical density of each channel."""
    return -np.log(np.clip(rgb.astype(np.float32) / 255.0, 1.0 / 255.0, 1.0))


def unmix(od: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hematoxylin, DAB and the residual of their fit."""
    both = od @ _UNMIX.T
    rest = np.sqrt(((od - both @ _BASIS.T) ** 2).sum(axis=-1))
    both = np.maximum(both, 0)
    return both[..., 0], both[..., 1], rest


def luma(rgb: np.ndarray) -> np.ndarray:
    """Gray value, 0 to 1."""
    return (rgb.astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32)) / 255.0


def sat_value(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Saturation and value, 0 to 1."""
    high = rgb.max(axis=-1).astype(np.float32) / 255.0
    low = rgb.min(axis=-1).astype(np.float32) / 255.0
    return np.where(high > 0, (high - low) / np.maximum(high, 1e-6), 0.0).astype(np.float32), high


def tissue_mask(od: np.ndarray, sat: np.ndarray, value: np.ndarray, o: PatchOptions, foreground: np.ndarray | None = None) -> np.ndarray:
    """Where there is tissue: dense or saturated pixels, without specks, closed and filled."""
    dense = od.sum(axis=-1) > o.od_tissue_threshold
    mask = (dense & (value < o.value_tissue_threshold)) | (sat > o.sat_tissue_threshold)
    mask = drop_small(mask, o.min_component_size)
    mask = fill_holes(erode(dilate(mask, 1), 1))
    return mask if foreground is None else mask & foreground


def slide_stats(rgb: np.ndarray, o: PatchOptions, foreground: np.ndarray | None = None) -> SlideStats:
    """Quantiles over the tissue, else over the foreground, else over everything."""
    if o.slide_stats_size is not None:
        rgb = resize(rgb, o.slide_stats_size, o.slide_stats_size)
        foreground = None if foreground is None else resize_mask(foreground, o.slide_stats_size, o.slide_stats_size)
    od = density(rgb)
    h, d, rest = unmix(od)
    use = tissue_mask(od, *sat_value(rgb), o, foreground)
    if not use.any():
        use = foreground if foreground is not None and foreground.any() else np.ones_like(use)
    return SlideStats(_q(d[use], 0.05), _q(d[use], 0.95, 1.0), _q(h[use], 0.05), _q(h[use], 0.95, 1.0), _q(rest[use], 0.95, 1.0))


def _shares(x: np.ndarray) -> np.ndarray:
    counts = np.histogram(x, bins=4, range=(0.0, 1.0))[0].astype(np.float32)
    return counts / counts.sum() if counts.sum() > 0 else counts


def describe(rgb: np.ndarray, stats: SlideStats, o: PatchOptions, foreground: np.ndarray | None = None) -> np.ndarray | None:
    """The 42 features of a tile in the order of ``BASE_FEATURES``, or None if it holds too little tissue."""
    if o.downsample_size is not None:
        rgb = resize(rgb, o.downsample_size, o.downsample_size)
        foreground = None if foreground is None else resize_mask(foreground, o.downsample_size, o.downsample_size)
    od, gray = density(rgb), luma(rgb)
    sat, value = sat_value(rgb)
    tissue = tissue_mask(od, sat, value, o, foreground)
    if tissue.mean() < o.tissue_min_fraction or not tissue.any():
        return None
    h, d, rest = unmix(od)
    scale = lambda x, low, high: np.clip((x - low) / max(high - low, 1e-3), 0, 1)
    hn, dn = scale(h, stats.h_q05, stats.h_q95), scale(d, stats.dab_q05, stats.dab_q95)
    rn = np.clip(rest / max(stats.residual_q95, 1e-3), 0, 1)
    nuclei, dab = tissue & (hn > o.nuclei_h_threshold), tissue & (dn > o.dab_positive_threshold)
    near, far = dilate(nuclei, 1), dilate(nuclei, 2)
    n = float(tissue.sum())
    sizes = areas(nuclei)
    edges, texture = gradient(gray), local_std(gray)
    fold = tissue & (gray < _q(gray[tissue], 0.10, 0.20)) & (texture < _q(texture[tissue], 0.30))
    border = np.ones_like(tissue)
    b = o.border_width
    border[b : max(tissue.shape[0] - b, 0), b : max(tissue.shape[1] - b, 0)] = False
    part = lambda m: float(m.sum() / n)
    places = [part(dab & nuclei), part(dab & tissue & far & ~near), part(dab & tissue & ~far)]
    ht, dt = hn[tissue], dn[tissue]
    hist_h, hist_d = _shares(ht), _shares(dt)
    found = {
        "tissue_frac": float(tissue.mean()), "odsum_mean": _mean(od.sum(axis=-1)[tissue]), "gray_mean": _mean(gray[tissue]), "sat_mean": _mean(sat[tissue]),
        "h_mean": _mean(ht), "h_std": _std(ht), "h_q10": _q(ht, 0.1), "h_q50": _q(ht, 0.5), "h_q90": _q(ht, 0.9),
        "d_mean": _mean(dt), "d_std": _std(dt), "d_q10": _q(dt, 0.1), "d_q50": _q(dt, 0.5), "d_q90": _q(dt, 0.9),
        "residual_mean": _mean(rn[tissue]), "residual_q90": _q(rn[tissue], 0.9),
        "h_hist_00_25": hist_h[0], "h_hist_25_50": hist_h[1], "h_hist_50_75": hist_h[2], "h_hist_75_100": hist_h[3],
        "d_hist_00_25": hist_d[0], "d_hist_25_50": hist_d[1], "d_hist_50_75": hist_d[2], "d_hist_75_100": hist_d[3],
        "d_pos_mean": _mean(dn[dab]), "nuclei_frac": part(nuclei), "nuclei_count_density": len(sizes) / n,
        "nuclei_area_mean": _mean(sizes) / n, "nuclei_area_cv": _std(sizes) / max(_mean(sizes), 1e-6),
        "dab_in_nuc_frac": places[0], "dab_ring_frac": places[1], "dab_extra_frac": places[2],
        "dab_cc_density": label(dab)[1] / n, "dab_edge_to_area": float((dilate(dab, 1) ^ dab).sum() / max(dab.sum(), 1)),
        "log_lap_var": float(np.log(np.var(laplace(gray)) + 1e-6)), "grad_mean": _mean(edges[tissue]), "grad_p90": _q(edges[tissue], 0.9),
        "hole_frac": part(fill_holes(tissue) & ~tissue), "unexpected_color_frac": part(tissue & (rn > 0.30)), "fold_frac": part(fold),
        "border_tissue_frac": part(tissue & border), "compartment_margin": sorted(places)[2] - sorted(places)[1],
    }
    return np.array([found[name] for name in BASE_FEATURES], np.float32)


def stain_jitter(rgb: np.ndarray, shift: tuple[float, float], gain: tuple[float, float]) -> np.ndarray:
    """Hematoxylin and DAB scaled and shifted, then back to 8-bit colour."""
    h, d, _ = unmix(density(rgb))
    both = np.stack([h * gain[0] + shift[0], d * gain[1] + shift[1]], axis=-1)
    return np.clip(np.rint(np.exp(-np.maximum(both, 0) @ _BASIS.T) * 255), 0, 255).astype(np.uint8)


# fixed values: colours of hematoxylin, eosin and DAB as optical densities, one stain a row
HED = [[0.65, 0.70, 0.29], [0.07, 0.99, 0.11], [0.27, 0.57, 0.78]]
# fixed values: half widths of gain and shift of each stain, and the weight of DAB, by strength
HED_STRENGTHS = {
    "weak": ((0.05, 0.05, 0.02), (0.03, 0.03, 0.01), 0.15),
    "medium": ((0.12, 0.12, 0.04), (0.06, 0.06, 0.015), 0.2),
    "strong": ((0.22, 0.22, 0.06), (0.12, 0.12, 0.02), 0.25),
}


def hed_jitter(rgb: np.ndarray, strength: str, seed: int) -> np.ndarray:
    """Three stains, each scaled and shifted by seeded draws, DAB weakened, and back to 8-bit colour."""
    if strength not in HED_STRENGTHS:
        raise ValueError(f"unknown strength {strength!r}: choose one of {sorted(HED_STRENGTHS)}")
    gain, shift, weight = (np.array(x) for x in HED_STRENGTHS[strength])
    draw = np.random.default_rng(seed).uniform(-1, 1, (2, 3))
    stains = -np.log(np.clip(rgb / 255.0, 1e-6, 1)) @ np.linalg.inv(np.array(HED))
    stains = (stains * (1 + draw[0] * gain) + draw[1] * shift) * np.array([1, 1, weight])
    return np.rint(np.clip(np.exp(-stains @ np.array(HED)), 0, 1) * 255).astype(np.uint8)


def permute_channels(rgb: np.ndarray, order: tuple[int, int, int]) -> np.ndarray:
    """Colour channels in another order."""
    if sorted(order) != [0, 1, 2]:
        raise ValueError("order must name every channel once")
    return rgb[..., list(order)]
