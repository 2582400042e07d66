import random

from marginalia.operators import shifts as Z

POINTS = "g long, x double, y double"


def brute(markers, entries, tol=1.5):
    """Every pair's shift against every marker."""
    out = {}
    for g in {r[0] for r in markers}:
        m = sorted({r[1:] for r in markers if r[0] == g and None not in r})
        e = sorted({r[1:] for r in entries if r[0] == g and None not in r})
        for a in m:
            for b in e:
                dx, dy = b[0] - a[0], b[1] - a[1]
                if g not in out and all(any(abs(f[0] - (k[0] + dx)) < tol and abs(f[1] - (k[1] + dy)) < tol for f in e) for k in m):
                    out[g] = (dx, dy)
    return out


def pages(rng, n):
    markers, entries = [], []
    for g in range(n):
        dx, dy, size = rng.randrange(-90, 90), rng.randrange(-90, 90), rng.randrange(1, 12)
        at = [(rng.randrange(60) * 1.0, rng.randrange(60) * 1.0) for _ in range(size)]
        jitter = lambda: rng.choice([0, 0, 0.7, -0.7, 1.1])
        entries += [(g, x + dx + jitter(), y + dy + jitter()) for x, y in at]
        drawn = at[: rng.randrange(1, size + 1)]
        if rng.random() < 0.3:
            drawn[0] = (500.0, 500.0)  # a marker that nothing explains
        markers += [(g, x, y) for x, y in drawn]
    return markers, entries


def test_same_as_all_shifts(spark):
    markers, entries = pages(random.Random(7), 60)
    markers += [(100, 1.0, 1.0), (101, None, 1.0), (102, 0.0, 0.0), (102, 0.0, 0.0), (None, 0.0, 0.0)]
    entries += [(101, 1.0, 1.0), (102, 5.0, 5.0), (102, 5.0, 5.0), (103, 1.0, 1.0), (None, 0.0, 0.0)]
    frames = [spark.createDataFrame(r, POINTS) for r in (markers, entries)]
    got = Z.consensus_shift(*frames, "g", "x", "y")
    want = brute(markers, entries)
    assert 20 < len(want) < 60 and {r.g: (r.dx, r.dy) for r in got.collect()} == want
    assert {r.g: r.markers for r in got.collect()}[102] == 2
    back = {}
    for r in Z.recovered(*frames, got, "g", "x", "y").collect():
        back.setdefault(r.g, set()).add((r.x, r.y))
    for g, (dx, dy) in want.items():
        m = [r[1:] for r in markers if r[0] == g]
        moved = {(r[1] - dx, r[2] - dy) for r in entries if r[0] == g}
        left = {(round(x, 3), round(y, 3)) for x, y in moved if not any(abs(x - a) < 2 and abs(y - b) < 2 for a, b in m)}
        assert back.get(g, set()) == left
    assert set(back) <= set(want)


def test_none(spark):
    none = spark.createDataFrame([], POINTS)
    assert Z.consensus_shift(none, none, "g", "x", "y").collect() == []


def test_groups_of_few_and_of_many_pairs_agree(spark, monkeypatch):
    frames = [spark.createDataFrame(r, POINTS) for r in pages(random.Random(11), 40)]
    found, written = [], []
    real = Z.stored
    monkeypatch.setattr(Z, "stored", lambda df, label: (written.append(label), real(df, label))[1])
    for most in (0, 20, 1_024):
        monkeypatch.setattr(Z, "SMALL", most)
        written.clear()
        shifts = Z.consensus_shift(*frames, "g", "x", "y")
        found.append((sorted(map(tuple, shifts.collect())), sorted(map(tuple, Z.recovered(*frames, shifts, "g", "x", "y").collect()))))
    assert found[0] == found[1] == found[2] and found[0][0]
    assert set(written) == {"shift-large"}  # no rounds are written for small groups


def test_a_shift_of_a_group_without_markers(spark):
    e, s = spark.createDataFrame([(1, 5.0, 5.0)], POINTS), spark.createDataFrame([(1, 1.0, 2.0)], "g long, dx double, dy double")
    assert [tuple(r) for r in Z.recovered(e.limit(0), e, s, "g", "x", "y").collect()] == [(1, 4.0, 3.0)]
