"""Sessions of hits and communications, nested pages and deal links, against plain loops."""
import random
from datetime import datetime, timedelta

import pytest

from ringlens.operators import flat as fl
from ringlens.operators import ordered
from ringlens.operators import sessions as ss

START = datetime(2024, 3, 1)
GAP = 1800
HITS, COMMS = "visitor_id int, date_time timestamp_ntz, event_id int, url string", "visitor_id int, date_time timestamp_ntz, event_id int, kind string"


def streams(seed=4):
    rng = random.Random(seed)

    def row(i):
        visitor = rng.choice([1, 1, 1, 2, 3, None])
        return visitor, START + timedelta(minutes=10 * rng.randrange(300)), i

    hits = [(*row(i), f"/p{i}") for i in range(250)]
    comms = [(*row(1000 + i), rng.choice(["call", "chat"])) for i in range(120)]
    return hits, comms


def plain(hits, comms):
    """(visitor, session number) of every row, and the sessions."""
    own, sessions = {}, {}
    for visitor in {h[0] for h in hits} | {c[0] for c in comms}:
        line = sorted([(h[1], 0, h[2]) for h in hits if h[0] == visitor] + [(c[1], 1, c[2]) for c in comms if c[0] == visitor])
        no, last = 0, None
        for at, side, ident in line:
            quiet = last is None or (at - last).total_seconds() > GAP
            if side == 0:
                no += quiet
                last = at
                sessions.setdefault((visitor, no), []).append((at, side, ident))
                own[ident] = no
            else:
                own[ident] = None if quiet else no
                if not quiet:
                    sessions[visitor, no].append((at, side, ident))
    return own, sessions


@pytest.mark.parametrize("heavy", [10**9, 4])
def test_sessions_against_a_loop(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    hits, comms = streams()
    rows = ss.session_rows(spark.createDataFrame(hits, HITS), spark.createDataFrame(comms, COMMS), GAP)
    own, sessions = plain(hits, comms)
    got = rows.collect()
    assert {r.event_id: r.session_no for r in got} == own and len(got) == len(own)
    for r in got:
        if r.session_no:
            line = sessions[r.visitor_id, r.session_no]
            assert r.session_start == line[0][0]
            later = [at for at, side, i in line if side == 0 and (at, i) > (r.date_time, r.event_id)]
            assert r.hit_duration == ((later[0] - r.date_time).total_seconds() if r.is_hit and later else None)
    summary = {(r.visitor_id, r.session_no): r for r in ss.session_summary(rows).collect()}
    assert summary.keys() == sessions.keys()
    for key, line in sessions.items():
        of_hits = [x for x in line if x[1] == 0]
        r = summary[key]
        assert (r.hits_count, r.communications_count) == (len(of_hits), len(line) - len(of_hits))
        assert (r.entrance_id, r.exit_id) == (of_hits[0][2], of_hits[-1][2])
        assert r.duration == (of_hits[-1][0] - of_hits[0][0]).total_seconds()


def test_the_page_is_nested_and_nothing_else(spark):
    hits, comms = streams(6)
    segments = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "c")], "visitor_id int, segment_name string")
    own, sessions = plain(hits, comms)
    order = sorted(sessions, key=lambda k: (-len([x for x in sessions[k] if x[1] == 0]), k[0] is None, k[0] or 0, k[1]))
    page = ss.nested_page(
        spark.createDataFrame(hits, HITS), spark.createDataFrame(comms, COMMS), segments, GAP,
        [("hits_count", "desc")], 5, 2, ("event_id", "url", "hit_duration"), ("event_id", "kind"), nested=3,
    )
    rows = {(r.visitor_id, r.session_no): r for r in page.collect()}
    assert set(rows) == set(order[2:7])
    for key, r in rows.items():
        assert [h.event_id for h in r.hits] == [i for _, side, i in sessions[key] if side == 0][:3]
        assert [h.url for h in r.hits] == [f"/p{h.event_id}" for h in r.hits]
        assert [c.event_id for c in r.communications] == [i for _, side, i in sessions[key] if side == 1][:3]
        assert r.hits_count == len([x for x in sessions[key] if x[1] == 0])
        assert r.segments == {1: ["a", "b"], None: ["n"], 2: ["c"]}.get(key[0], [])


def test_deal_links(spark):
    day = lambda n: START + timedelta(days=n)
    deals = spark.createDataFrame([(1, 7, day(0)), (2, 7, day(5)), (3, 8, day(1)), (4, None, day(1))], "call_id int, contact_id int, start_time timestamp_ntz")
    calls = spark.createDataFrame([(1, 11, day(9)), (9, 12, day(9))], "deal_id int, ref_id int, at timestamp_ntz")
    chats = spark.createDataFrame([(7, 21, day(4)), (7, 22, day(5)), (8, 23, day(0)), (None, 24, day(9))], "contact_id int, ref_id int, at timestamp_ntz")
    got = {tuple(r)[:3] for r in fl.deal_links(deals, call=calls, chat=chats).collect()}
    assert got == {(1, "call", 11), (1, "chat", 21), (2, "chat", 22)}
