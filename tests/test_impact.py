"""Impact over any number of steps: chains, circles, junctions, routes of different age."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from faultline.operators.impact import impact
from faultline.schemas import LINEAGE

DAY = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    made = [{"source_table_full_name": s, "target_table_full_name": t, "event_time": e} for s, t, e in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in LINEAGE.fields) for r in made], LINEAGE)


def slow(rows, start):
    """Breadth first; a level's table keeps the most recent of its routes."""
    steps = {}
    for s, t, e in rows:
        if s is not None and t is not None and s != t:
            steps.setdefault(s, {})[t] = max(steps.get(s, {}).get(t, e), e)
    found, level, depth = {start: (0, dt.datetime.max)}, [start], 0
    while level:
        depth, nxt = depth + 1, {}
        for s in level:
            for t, e in steps.get(s, {}).items():
                if t not in found:
                    nxt[t] = max(nxt.get(t, dt.datetime.min), min(found[s][1], e))
        found |= {t: (depth, e) for t, e in nxt.items()}
        level = list(nxt)
    return {t: v for t, v in found.items() if t != start}


def run(spark, rows, start, direction="downstream"):
    got = impact(frame(spark, rows), start, direction).collect()
    assert len({r.table_name for r in got}) == len(got)
    return {r.table_name: (r.depth, r.last_seen) for r in got}


def day(n):
    return DAY + dt.timedelta(days=n)


def test_a_chain_of_a_thousand_takes_few_steps(spark, monkeypatch):
    from faultline.operators import impact as module

    steps, plain = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: (steps.append(name), plain(df, name))[1])
    rows = [(f"t{i}", f"t{i + 1}", day(5000 - i)) for i in range(1000)]
    assert run(spark, rows, "t0") == {f"t{i + 1}": (i + 1, day(5000 - i)) for i in range(1000)}
    assert len(steps) < 30


def test_circles_end(spark):
    rows = [("a", "b", day(1)), ("b", "c", day(2)), ("c", "a", day(3)), ("c", "c", day(9)), ("x", "y", day(1)), ("y", "x", day(1))]
    assert run(spark, rows, "a") == {"b": (1, day(1)), "c": (2, day(1))} == slow(rows, "a")
    assert run(spark, rows, "a", "upstream") == {"c": (1, day(3)), "b": (2, day(2))}
    assert run(spark, rows, "x") == {"y": (1, day(1))}


def test_short_routes_first_then_recent_ones(spark):
    rows = [("a", "b", day(9)), ("b", "d", day(2)), ("a", "c", day(5)), ("c", "d", day(6)), ("a", "e", day(1)), ("d", "e", day(9))]
    assert run(spark, rows, "a") == {"b": (1, day(9)), "c": (1, day(5)), "d": (2, day(5)), "e": (1, day(1))} == slow(rows, "a")


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs_with_tails_and_repeats(spark, seed):
    r = random.Random(seed)
    rows = [(f"t{r.randrange(30)}", f"t{r.randrange(30)}", day(r.randrange(300))) for _ in range(45)]
    rows += [(f"t{i}", f"u{i}", day(r.randrange(300))) for i in range(30)] + [(f"u{i}", f"v{i}", day(r.randrange(300))) for i in range(30)]
    rows += [(None, "t1", day(1)), ("t1", None, day(1)), rows[0], rows[0]]
    assert run(spark, rows, "t0") == slow(rows, "t0")
    back = [(t, s, e) for s, t, e in rows]
    assert run(spark, rows, "v3", "upstream") == slow(back, "v3")


def test_tables_without_steps_and_empty_logs(spark):
    assert run(spark, [("a", "b", day(1))], "b") == {} == run(spark, [], "a")
    with pytest.raises(ValueError):
        impact(frame(spark, []), "a", "sideways")


def test_rounds_hold_only_tables_that_are_fed_and_feed(spark, monkeypatch):
    from faultline.operators import impact as module

    sizes, plain = [], module.written

    def kept(df, name):
        made = plain(df, name)
        sizes.append((name, made.count()))
        return made

    monkeypatch.setattr(module, "written", kept)
    # Ten inner tables of two feeders each, below them 300 leaves and beside them 300 roots that nothing feeds.
    rows = [(f"t{i}", f"t{j}", day(i + j)) for i in range(10) for j in (i + 1, i + 2)]
    rows += [(f"t{i % 10}", f"leaf{i // 2}", day(i % 37)) for i in range(600)]
    rows += [(f"root{i}", f"t{i % 10}", day(i % 41)) for i in range(300)]
    assert run(spark, rows, "t0") == slow(rows, "t0")
    rounds = [(name, n) for name, n in sizes if name != "impact-steps"]
    assert max(n for _, n in rounds) <= 40
    # One file of results a round: t2 is the last to be improved, eleven tables are known.
    assert len(rounds) < 2 * 10


def test_steps_without_a_time_do_not_make_a_route_older(spark):
    rows = [("a", "b", None), ("b", "d", day(2)), ("a", "c", day(5)), ("c", "d", day(6)), ("x", "d", day(9))]
    assert run(spark, rows, "a") == {"b": (1, None), "c": (1, day(5)), "d": (2, day(5))}
    # Equally long routes to f that are found in different rounds; that by way of e has no time.
    rows = [("a", "p", day(1)), ("p", "q", day(1)), ("q", "f", day(1)), ("a", "e", None), ("z", "e", None), ("e", "g", None), ("z", "g", None)]
    rows += [("g", "f", None), ("f", "h", day(7))]
    got = run(spark, rows, "a")
    assert got["f"] == (3, None) and got["h"] == (4, day(7))


@pytest.mark.parametrize("limit", [0, 200])
def test_fronts_past_the_broadcast_bound(spark, monkeypatch, limit):
    from faultline.operators import impact as module

    monkeypatch.setattr(module, "DEFAULT_BROADCAST_MAX_BYTES", limit)
    r = random.Random(7)
    rows = [(f"t{r.randrange(40)}", f"t{r.randrange(40)}", day(r.randrange(300))) for _ in range(70)]
    assert run(spark, rows, "t0") == slow(rows, "t0")
