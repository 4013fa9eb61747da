"""Reading shirt numbers again in crops of a segment's images.

``ImageReader`` is the reader of resolve.resolved(): it chooses frames and
rectangles, and calls the functions of a caller's recogniser on enlarged crops.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from statistics import median

import numpy as np

from spanwright.functions.text import NO_TABLE_NAMES, NUMBER
from spanwright.operators.resolve import Pair, Row, anchors, by_frame, inline, name_like, regular_rows, retry_frames, table_pairs

#: Texts and scores that a recogniser finds in an image.
Found = list[tuple[str, float]]

# Of a formation's attempts, the half width, the reach up and down of a crop around
# a name, all in shares of the image, how much it is enlarged, and whether pixels are rounded.
FIRST, SECOND, THIRD = (0.020, 0.088, 0.030, 8, True), (0.022, 0.080, 0.035, 7, False), (0.015, 0.080, 0.035, 8, False)
#: Of a table: half the width of a crop around the numbers, its height in steps between rows, enlargement.
COLUMN, HEIGHT, LEAST_HEIGHT, ENLARGED = 0.035, 0.43, 18, 3
TABLE_SCORE, FORMATION_SCORE, ABOVE_NAME = 0.60, 0.75, 0.058


def repeated(image: np.ndarray, times: int) -> np.ndarray:
    """The image enlarged by repeating its pixels; a caller may have a smoother way."""
    return image.repeat(times, axis=0).repeat(times, axis=1)


def best_number(found: Found, least: float) -> tuple[int, float] | None:
    """The number of 1 to 99 with the best score; the first of equals."""
    good = [(int(t.strip()), s) for t, s in found if t.strip().isascii() and t.strip().isdigit() and 1 <= int(t) <= 99 and s >= least]
    return max(good, key=lambda g: g[1], default=None)


def rectangle(row: Row, width: int, height: int, half: float, up: float, down: float, rounded: bool) -> tuple[int, int, int, int]:
    """x1, y1, x2, y2 of the crop above a name, within the image."""
    whole = (lambda v: int(round(v))) if rounded else int
    left, right = max(0, whole((row.x - half) * width)), min(width, whole((row.x + half) * width))
    return left, max(0, whole((row.y - up) * height)), right, min(height, whole((row.y - down) * height))


def table_frames(pairs: list[Pair], most: int = 3, least: int = 4) -> list[tuple[int, list[Pair]]]:
    """The earliest frame with enough pairs of number and name, then those with the most."""
    frames: dict[int, list[Pair]] = {}
    for pair in pairs:
        if pair.apart:
            frames.setdefault(pair.frame, []).append(pair)
    usable = {f: p for f, p in frames.items() if len(p) >= least}
    if not usable:
        return []
    ranked = sorted(usable, key=lambda f: (-len(usable[f]), f))
    first = min(usable)
    return [(f, usable[f]) for f in [first, *(f for f in ranked if f != first)][:most]]


@dataclass
class ImageReader:
    #: The image of a path, rows by columns by channels; None if there is none.
    image: Callable[[str], np.ndarray | None]
    #: Texts found in each of some images.
    read: Callable[[list[np.ndarray]], list[Found]]
    #: The one text of each of some images, without looking for where it is.
    recognise: Callable[[list[np.ndarray]], list[Found]] | None = None
    enlarge: Callable[[np.ndarray, int], np.ndarray] = repeated

    def table(self, rows: list[Row], players: int) -> list[Row]:
        added: list[Row] = []
        frames = by_frame(rows)
        for frame, pairs in table_frames(table_pairs(rows)):
            members = frames[frame]
            names = regular_rows(members, median(p.left for p in pairs), players)
            image = self.image(members[0].path) if len(names) == players and members[0].path else None
            if image is None:
                continue
            height, width = image.shape[:2]
            x = median(p.x for p in pairs)
            step = median(b.y - a.y for a, b in zip(names, names[1:])) if len(names) > 1 else 0.0
            half = max(LEAST_HEIGHT, int(round(step * height * HEIGHT)))
            left, right = max(0, int(round((x - COLUMN) * width))), min(width, int(round((x + COLUMN) * width)))
            middles = [int(round(r.y * height)) for r in names]
            crops = [self.enlarge(image[max(0, m - half) : min(height, m + half), left:right], ENLARGED) for m in middles]
            found = self.read(crops)
            if len(found) == len(names):
                added += [self._number(r, n, x, r.y, x * width - 20) for r, f in zip(names, found) if (n := best_number(f, TABLE_SCORE))]
        return _numbered(rows, added)

    def formation(self, rows: list[Row]) -> list[Row]:
        added: list[Row] = []
        frames = by_frame(rows)
        for frame in retry_frames(rows):
            members = frames[frame]
            image = self.image(members[0].path) if members[0].path else None
            if image is None:
                continue
            height, width = image.shape[:2]
            under = [name for _, name in anchors(members)]
            low, high = (f(r.x for r in under) for f in (min, max))
            top, bottom = (f(r.y for r in under) for f in (min, max))
            names = [
                r for r in members
                if r.kind != NUMBER and name_like(r.norm, NO_TABLE_NAMES) and not inline(r.text) and low - 0.09 <= r.x <= high + 0.09 and top - 0.08 <= r.y <= bottom + 0.40 and r.y <= 0.82
            ]
            boxes = [(r, rectangle(r, width, height, *FIRST[:3], FIRST[4])) for r in names]
            names = [r for r, (x1, y1, x2, y2) in boxes if x2 > x1 and y2 > y1]
            numbers = self._attempts(image, names)
            added += [self._number(r, n, r.x, r.y - ABOVE_NAME, r.x * width - 18) for r, n in zip(names, numbers) if n]
        return _numbered(rows, added)

    def _attempts(self, image: np.ndarray, names: list[Row]) -> list[tuple[int, float] | None]:
        """The number above each name; smaller crops where one isn't found."""
        numbers: list[tuple[int, float] | None] = [None] * len(names)
        for read, (half, up, down, times, rounded) in ((self.read, FIRST), (self.read, SECOND), (self.recognise, THIRD)):
            open_ = [i for i, n in enumerate(numbers) if n is None]
            if not open_ or read is None:
                continue
            boxes = [rectangle(names[i], image.shape[1], image.shape[0], half, up, down, rounded) for i in open_]
            found = read([self.enlarge(image[y1:y2, x1:x2], times) for x1, y1, x2, y2 in boxes])
            if len(found) != len(open_):
                if times == FIRST[3] and rounded:
                    break
                raise ValueError(f"{len(found)} results for {len(open_)} images")
            for i, f in zip(open_, found):
                numbers[i] = best_number(f, FORMATION_SCORE)
        return numbers

    def _number(self, name: Row, number: tuple[int, float], x: float, y: float, left: float) -> Row:
        value, score = number
        x1 = int(round(left)) if name.x1 is not None else None
        return replace(name, text=str(value), norm=str(value), kind=NUMBER, score=round(score, 6), x=round(x, 6), y=round(y, 6), x1=x1)


def _numbered(rows: list[Row], added: list[Row]) -> list[Row]:
    """The added rows with ids after all others."""
    last = max((r.row_id for r in rows), default=0)
    return [replace(r, row_id=last + i) for i, r in enumerate(added, start=1)]
