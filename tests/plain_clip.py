"""Common area of two rings by clipping with half-planes: the slow version that the batch is compared with."""

from fieldbook.functions.geo import Point, Signed, _cross, _to_mercator, _twice_area
from collections.abc import Sequence


def _convex_pieces(ring: tuple[Point, ...]) -> list[tuple[int, list[Point]]]:
    """The ring itself when convex, else the triangles from its first point to each side.

    Triangles that turn against the ring count as negative, so that the signed pieces add up to any simple ring, concave or not.
    """
    turned = _twice_area(ring) >= 0
    around = list(ring) if turned else list(ring[::-1])
    turns = [_cross(around[i - 2], around[i - 1], around[i]) for i in range(len(around))]
    if min(turns) >= 0 and _once_around(around):
        return [(1, around)]
    pieces = []
    for a, b in zip(around[1:], around[2:]):
        area = _cross(around[0], a, b)
        if area:
            pieces.append((1, [around[0], a, b]) if area > 0 else (-1, [around[0], b, a]))
    return pieces


def _once_around(ring: Sequence[Point]) -> bool:
    """A ring that only turns left is convex if its directions go round once."""
    sides = [(q[0] - p[0], q[1] - p[1]) for p, q in zip(ring, [*ring[1:], ring[0]])]
    half = [(y < 0) or (y == 0 and x < 0) for x, y in sides]
    return sum(a != b for a, b in zip(half, [*half[1:], half[0]])) <= 2


def _clip(subject: Sequence[Point], window: Sequence[Point]) -> list[Point] | None:
    """Part of ``subject`` inside a counter-clockwise convex ``window``, half-plane by half-plane."""
    out = list(subject)
    for k, b in enumerate(window):
        a = window[k - 1]
        side = [_cross(a, b, p) for p in out]
        kept = []
        for i, p in enumerate(out):
            q, s = out[i - 1], side[i - 1]
            if s * side[i] < 0:
                t = s / (s - side[i])
                kept.append((q[0] + (p[0] - q[0]) * t, q[1] + (p[1] - q[1]) * t))
            if side[i] >= 0:
                kept.append(p)
        if len(kept) < 3:
            return None
        out = kept
    return out


def common(a: Signed, b: Signed) -> tuple[float, float]:
    """Signed common area of two rings, in square degrees and square mercator metres."""
    (sign_a, ring_a), (sign_b, ring_b) = a, b
    pieces, subject = _convex_pieces(ring_b), ring_a
    if len(pieces) > 1 and len(own := _convex_pieces(ring_a)) < len(pieces):
        pieces, subject = own, ring_b
    found = [(sign, part) for sign, piece in pieces if (part := _clip(subject, piece)) is not None]
    area = sum(sign * abs(_twice_area(part)) / 2 for sign, part in found)
    return sign_a * sign_b * area, sign_a * sign_b * sum(sign * abs(_twice_area(_to_mercator(part))) / 2 for sign, part in found)


def _apart(a: Sequence[Point], b: Sequence[Point]) -> bool:
    return any(max(p[i] for p in x) <= min(p[i] for p in y) for i in (0, 1) for x, y in ((a, b), (b, a)))
