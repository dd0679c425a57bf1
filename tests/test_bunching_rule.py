"""The bunching rule over a stream: many reports at a time, whatever the size of its steps."""

import numpy as np
import pytest
from helpers import bunching

from citystream.streaming import detectors


@pytest.mark.parametrize("cells", [1, 7, 1 << 20])
def test_steps_of_any_size_give_the_alerts_of_a_replay(cells):
    r = np.random.default_rng(5)
    rows = [("R", f"b{b}", 20 * i, 12.97 + .001 * int(r.integers(0, 4)) * (r.random() < .08), 77.59) for i, b in enumerate(r.integers(0, 4, 900))]
    me, ms = np.array([int(x[1][1]) for x in rows]), np.array([1000 * x[2] for x in rows])
    x, y = np.array([x[3] for x in rows]), np.array([x[4] for x in rows])
    lat, lon, near, told, found = np.full(4, np.nan), np.full(4, np.nan), {}, {}, []
    step = max(1, cells // 4)
    for first in range(0, len(rows), step):
        part = slice(first, first + step)
        for i, bus, other, metres, _ in zip(*detectors._bunched(me[part], x[part], y[part], ms[part], lat, lon, near, told, 200, 300_000, 300_000)):
            found.append(("R", f"b{min(bus, other)}", f"b{max(bus, other)}", rows[first + i][2], round(float(metres), 2)))
    assert len(found) > 20 and sorted(found) == sorted(bunching(rows))
