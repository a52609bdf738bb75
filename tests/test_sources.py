"""Text readers, metadata, listings, ordering and ancestry against brute force."""

import hashlib
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from leptide.functions.identity import add_event_uid, decode_fault, sequence_digest_groups
from leptide.operators import ancestry, dressing, ordering
from leptide.session import scratch_path
from leptide.sources import hepmc, lhe, listing, metadata

EVENT = "<event>\n 2 1 {w} 0 0 0\n 11 1 0 0 0 0 1.0D0 2 3 4.5 0 0 9\n -11 1 0 0 0 0 -1 -2 -3 4.5 0 0 9\n{rest}</event>\n"
HEAD = "<LesHouchesEvents>\n<header>\n</header>\n<init>\n2212 2212 6500 6500 0 0 0 0 -4 1\n1.5D1 0.5 1 7\n</init>\n"


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)
    return os.path.join(path, name)


def test_lhe_document_roundtrip_and_faults(spark, tmp_path):
    rw = "<rwgt>\n<wgt id='1001'> 0.5D-1 </wgt>\n</rwgt>\n"
    good = write(tmp_path / "a", "good.lhe", HEAD + EVENT.format(w="-2.5D0", rest=rw) + EVENT.format(w="1.5", rest="") + "</LesHouchesEvents>\n")
    events, pre, bad = lhe.read_documents(spark, good)
    assert bad.count() == 0
    rows = lhe.parse_events(events).orderBy("ordinal").collect()
    assert [r.weight for r in rows] == [-2.5, 1.5] and [r.ordinal for r in rows] == [1, 2]
    assert rows[0].weights == {"1001": 0.05} and rows[0].particles[0].px == 1.0 and rows[0].fault is None
    init = lhe.parse_init(pre).first()
    assert (init.idwtup, init.inclusive_cross_section_pb, init.fault) == (-4, 15.0, None)
    cases = {
        "missing root close": HEAD + EVENT.format(w="1", rest=""),
        "unterminated event": HEAD + EVENT.format(w="1", rest="") + "<event>\n 2 1 1",
        "content between events": HEAD + EVENT.format(w="1", rest="") + "junk\n" + EVENT.format(w="1", rest="") + "</LesHouchesEvents>",
    }
    for i, (want, text) in enumerate(cases.items()):
        path = write(tmp_path / f"b{i}", "x.lhe", text)
        assert want in {r.observed for r in lhe.read_documents(spark, path)[2].collect()}
    broken = spark.createDataFrame([(k, t) for k, t in enumerate([
        EVENT.format(w="nan", rest=""), "<event>\n 3 1 1 0 0 0\n 11 1 0 0 0 0 1 2 3 4\n</event>", "<event>\n</event>"])], "k int, text string")
    assert [r.fault for r in lhe.parse_events(broken).orderBy("k").collect()] == ["bad nominal weight", "fewer particles than declared", "no event line"]


def test_one_big_document_is_split_over_tasks(spark, tmp_path):
    n = 4000
    text = HEAD + "".join(EVENT.format(w=str(i + 1), rest="") for i in range(n)) + "</LesHouchesEvents>\n"
    path = write(tmp_path / "c", "big.lhe", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        events, _, bad = lhe.read_documents(spark, path)
        rows = lhe.parse_events(events).select("ordinal", "weight").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert bad.count() == 0
    assert sorted((r.ordinal, r.weight) for r in rows) == [(i + 1, float(i + 1)) for i in range(n)]


def test_tagging_adds_markers_once(spark):
    df = spark.createDataFrame([(5, EVENT.format(w="1", rest=""))], "source_event_id int, text string")
    tagged = df.selectExpr("source_event_id", f"{lhe.tag_event_text()} as text")
    row = lhe.parse_events(tagged).first()
    assert row.weights == {"AUX_OAP_EVENT_ID": 5.0, "AUX_OAP_EVENT_UNIT": 1.0} and row.source_comment_id == 5
    assert lhe.marker_findings(lhe.parse_events(tagged), ["source_event_id"]).count() == 0
    with pytest.raises(Exception, match="already carries"):
        tagged.selectExpr(f"{lhe.tag_event_text()} as t").collect()


def _hepmc(names='N 3 "Default" "id=AUX_AUX_OAP_EVENT_ID_MERGING=0.000" "AUX_OAP_EVENT_UNIT"', weights="3 1.0 {a} 2.0", tail=True):
    ev = "".join(f"E {n} 0 -1 -1 -1 0 0 1 1 2 1 99 {weights.format(a=2.0 * i)}\n{names}\nU GEV MM\n" for n, i in ((7, 3), (9, 5)))
    return "HepMC::Version 2.06\nHepMC::IO_GenEvent-START_EVENT_LISTING\n" + ev + ("HepMC::IO_GenEvent-END_EVENT_LISTING\n" if tail else "")


def test_hepmc_canonicalization(spark, tmp_path):
    events, bad = hepmc.read_hepmc(spark, write(tmp_path / "h", "a.hepmc", _hepmc()))
    assert bad.count() == 0
    rows = hepmc.with_source_ids(hepmc.canonicalize(events, 41)).orderBy("ordinal").collect()
    assert [r.event_number for r in rows] == [41, 42] and [r.source_event_id for r in rows] == [3, 5]
    assert rows[0].names == ["Default", "AUX_OAP_EVENT_ID", "AUX_OAP_EVENT_UNIT"] and rows[0].name_fault is None
    for i, text in enumerate((_hepmc(tail=False), _hepmc(weights="4 1.0 {a} 2.0"), _hepmc(names='N 3 "a" "a" "b"'))):
        assert hepmc.read_hepmc(spark, write(tmp_path / f"h{i}", "b.hepmc", text))[1].count() > 0
    two, _ = hepmc.read_hepmc(spark, write(tmp_path / "h9", "c.hepmc", _hepmc(names='N 3 "xAUX_OAP_EVENT_ID" "AUX_OAP_EVENT_ID" "AUX_OAP_EVENT_UNIT"')))
    assert {r.name_fault for r in hepmc.canonicalize(two, 1).collect()} == {"ambiguous marker name"}


def test_key_value_rules(spark):
    lines = spark.createDataFrame([("f", "a = 1=2"), ("f", "# c"), ("f", ""), ("f", "a=3"), ("f", "junk"), ("f", "=x")], "file string, value string")
    good, bad = metadata.parse_key_value(lines)
    assert ("f", "a", "1=2") in {tuple(r) for r in good.collect()}
    assert sorted(r.rule for r in bad.collect()) == ["keyvalue.duplicate", "keyvalue.line", "keyvalue.line"]


def test_completed_jobs_and_changed_files(spark, tmp_path):
    for j in (1, 2):
        write(tmp_path / f"job{j}", "out.parquet", "x")
    write(tmp_path / "job1", "SUCCESS", "ok")
    files = listing.list_files(spark, str(tmp_path))
    usable, bad = listing.completed_jobs(files, "out.parquet")
    assert usable.count() == 1 and [r.observed for r in bad.collect()] == ["no success marker"]
    with pytest.raises(ValueError):
        listing.require_inputs(usable)
    before = spark.createDataFrame(listing.content_fingerprints(spark, str(tmp_path)).collect())
    write(tmp_path / "job2", "out.parquet", "y")
    assert listing.changed_files(before, listing.content_fingerprints(spark, str(tmp_path))).count() == 1


def test_uid_and_sequence_digest(spark):
    df = spark.createDataFrame([(7, 1, 3, i) for i in (5, 2, 9)], "campaign_id bigint, sample_code int, job_id bigint, source_event_id bigint")
    row = {r.source_event_id: r for r in add_event_uid(df, b"tag\0").collect()}[5]
    raw = hashlib.blake2b(b"tag\0" + (7).to_bytes(8, "big") + b"\x01" + (3).to_bytes(4, "big") + (5).to_bytes(8, "big"), digest_size=16).digest()
    assert int(row.event_uid_hi) == int.from_bytes(raw[:8], "big") and int(row.event_uid_lo) == int.from_bytes(raw[8:], "big")
    want = hashlib.sha256(b"".join(i.to_bytes(8, "big") for i in (2, 5, 9))).hexdigest()
    assert sequence_digest_groups(df, keys=["job_id"], value="source_event_id").first().sequence_sha256 == want


def test_sequence_digest_of_a_long_group(spark):
    """A group of many batches among small ones gets the digest of its whole sequence."""
    n = 200_000
    df = spark.range(n).selectExpr("bigint(1) as job_id", "id * 7 % 1000003 as x").unionByName(
        spark.range(40).selectExpr("2 + id % 5 as job_id", "if(id = 7, null, id) as x")
    )
    got = {r.job_id: (r.n, r.sequence_sha256) for r in sequence_digest_groups(df, keys=["job_id"], value="x").collect()}
    for job, ids in {1: sorted(i * 7 % 1000003 for i in range(n)), **{2 + k: [i for i in range(k, 40, 5) if i != 7] for k in range(5)}}.items():
        want = hashlib.sha256(b"".join(i.to_bytes(8, "big") for i in ids)).hexdigest()
        assert got[job] == (len(ids) + (job == 4), want)


def test_decode_faults(spark):
    rows = [(6.0, 2.0, None), (6.0, 0.0, "zero unit marker"), (math.nan, 1.0, "non-finite marker"), (2.5, 1.0, "not integral"), (-3.0, 1.0, "out of range"), (1e7, 1.0, "ratio too large")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "i int, a double, b double")
    assert [r.f for r in df.selectExpr("i", f"{decode_fault('a', 'b')} as f").orderBy("i").collect()] == [x[2] for x in rows]


def test_ranks_in_a_hot_group(spark):
    rng = random.Random(1)
    ids = rng.sample(range(100000), 3000)
    rows = [(1 if k % 3 else k, i) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "job bigint, id bigint")
    got = {(r.job, r.id): (r.ordinal, r.previous) for r in ordering.with_previous(ordering.with_rank(df, ["job"], "id", width=500), ["job"], "id", "id", width=700).collect()}
    by_job = {}
    for j, i in rows:
        by_job.setdefault(j, []).append(i)
    for j, xs in by_job.items():
        xs.sort()
        for k, i in enumerate(xs):
            assert got[j, i] == (k, xs[k - 1] if k else None)


def _brute(particles, flavor):
    """Walk up from every particle, as an independent check."""
    at = {p[1]: p for p in particles}
    mothers = lambda p: [m for m in dict.fromkeys((p[4], p[5])) if m in at]
    had = lambda x: x not in (230, 231, -230, -231) and (100 <= abs(x) < 1000000 or abs(x) >= 1000000000)
    hadrons, bosons, hard = set(), set(), set()
    for p in particles:
        seen, todo = set(), mothers(p)
        while todo:
            i = todo.pop()
            if i in seen:
                continue
            seen.add(i)
            if had(at[i][2]):
                hadrons.add(p[1])
                break
            if not (abs(at[i][2]) <= 6 or abs(at[i][2]) == 21):
                todo += mothers(at[i])
        seen, todo = set(), mothers(p) if abs(p[2]) == flavor else []  # lines of that flavour only
        while todo:
            i = todo.pop()
            if i in seen:
                continue
            seen.add(i)
            if abs(at[i][2]) in (23, 24, 230, 231) or (abs(at[i][2]) == 22 and at[i][6] > 5):
                bosons.add(p[1])
                break
            if abs(at[i][2]) == flavor:
                todo += mothers(at[i])
        seen, todo = set(), [p[1]] if abs(p[2]) in (11, 13) else []  # charged leptons only
        while todo:
            i = todo.pop()
            if i in seen or at[i][2] != p[2]:
                continue
            seen.add(i)
            ms = mothers(at[i])
            if at[i][3] in (1, 23) and len(ms) == 2 and all(at[m][2] == 21 and at[m][3] == 21 for m in ms):
                hard.add(p[1])
                break
            todo += [m for m in ms if at[m][2] == p[2]]
    return hadrons, bosons, hard


def test_ancestry_matches_brute_force_with_cycles(spark):
    rng = random.Random(5)
    rows = []
    for ev in range(12):
        n = 25
        for i in range(n):
            pid = rng.choice([11, 11, 13, -11, 21, 21, 22, 23, 4, 211, 15])
            rows.append((ev, i, pid, 21 if pid == 21 else rng.choice([1, 23, 44]), rng.randrange(-1, n), rng.randrange(-1, n + 3), rng.choice([0.0, 7.0])))
    p = spark.createDataFrame(rows, "event_id bigint, idx int, pid int, status int, m1 int, m2 int, mass double")
    links = ancestry.mother_links(p)
    got = [
        {(r.event_id, r.idx) for r in ancestry.hadron_descendants(links).collect()},
        {(r.event_id, r.idx) for r in ancestry.boson_descendants(links, (11,)).collect()},
        {(r.event_id, r.idx) for r in ancestry.hard_process_descendants(p, links).collect()},
    ]
    want = [set(), set(), set()]
    for ev in range(12):
        for k, s in enumerate(_brute([r for r in rows if r[0] == ev], 11)):
            want[k] |= {(ev, i) for i in s}
    assert got == want


def test_leptons_enter_only_the_cells_their_cones_touch(spark):
    rng = random.Random(4)
    rows = [(0, i, rng.uniform(-3, 3), rng.uniform(-math.pi, math.pi)) for i in range(2000)]
    l = spark.createDataFrame(rows, "event_id int, lepton_id int, eta double, phi double")
    placed, _ = dressing.entered(l, l.withColumnRenamed("lepton_id", "photon_id"), 0.1)
    assert 2000 <= placed.count() < 3 * 2000


def test_nearest_lepton_matches_brute_force_across_the_seam(spark):
    rng = random.Random(3)
    pt = lambda n, c: [(0, i, rng.uniform(-1, 1), rng.choice([math.pi - 0.05, -math.pi + 0.05, 0.5]) + rng.uniform(-0.05, 0.05)) for i in range(n)]
    fix = lambda rows: [(e, i, a, (f + math.pi) % (2 * math.pi) - math.pi) for e, i, a, f in rows]
    ls, ps = fix(pt(60, 0)), fix(pt(200, 1))
    l = spark.createDataFrame(ls, "event_id int, lepton_id int, eta double, phi double")
    p = spark.createDataFrame(ps, "event_id int, photon_id int, eta double, phi double")
    got = {r.photon_id: r.lepton_id for r in dressing.nearest_lepton(l, p, 0.1).collect()}
    want = {}
    for _, k, a, f in ps:
        best = min((math.hypot(a - b, (f - g + math.pi) % (2 * math.pi) - math.pi), i) for _, i, b, g in ls)
        if best[0] < 0.1:
            want[k] = best[1]
    assert got == want


def test_scratch_path_uses_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and spark.sparkContext.getCheckpointDir() in a
    assert F is not None


def test_markers_are_inserted_once(spark):
    """A closing tag repeated in a comment gets nothing; blocks are made where there are none."""
    texts = ["<header>\n<initrwgt>\n</initrwgt>\n</header>\n<!-- </initrwgt> </header> -->", "<header>\n</header>\n<!-- </header> -->"]
    df = spark.createDataFrame([(t,) for t in texts], "preamble string")
    for row in df.selectExpr(f"{lhe.tag_preamble()} as t").collect():
        assert row.t.count("<weightgroup") == 1 and row.t.count("<initrwgt>") == 1 and row.t.index("</weightgroup>") < row.t.index("</initrwgt>")
    with pytest.raises(Exception, match="neither"):
        spark.sql(f"select {lhe.tag_preamble()} from (select 'no block' as preamble)").collect()


def test_records_are_numbered_without_moving_the_text(spark, tmp_path):
    path = write(tmp_path / "many", "a.txt", "|".join(f"r{i}" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = listing.read_records(spark, path, "|")
        rows = sorted((r.chunk, r.record, r.last_chunk) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [(i, f"r{i}", 4999) for i in range(5000)]
    assert not any("record" in line for line in plan.splitlines() if "Exchange" in line)


def test_payload_digest_ignores_order_only(spark):
    from leptide.functions.identity import payload_digest

    rows = [(1, 5, 0.1, "a"), (1, 6, -2.5e300, None), (1, 5, 0.1, "a"), (2, None, float("nan"), ""), (2, 7, float("-inf"), "a|1:b"), (2, 8, None, "-")]
    df = spark.createDataFrame(rows, "k int, i long, x double, s string")
    digest = lambda d: {r["k"]: tuple(r)[1:] for r in payload_digest(d, keys=["k"], columns=["i", "x", "s"]).collect()}
    want = digest(df)
    assert digest(df.repartition(5).orderBy("x")) == want and want[1][0] == 3
    for i in range(len(rows)):
        for j, other in ((1, 99), (2, 1.25), (3, "b")):
            changed = [list(r) for r in rows]
            changed[i][j] = other
            assert digest(spark.createDataFrame(changed, "k int, i long, x double, s string"))[rows[i][0]] != want[rows[i][0]]
        break
    once = digest(spark.createDataFrame(rows[:2] + rows[3:], "k int, i long, x double, s string"))
    assert once[1] != want[1] and once[2] == want[2]


@pytest.mark.parametrize("most", [1 << 21, 0])
def test_flags_reach_all_descendants(spark, most):
    """Deep chains, diamonds, cycles, several events and flavours, in a task and by joins."""
    import random

    from leptide.operators import ancestry

    rng, links, seeds = random.Random(3), [], []
    deep = 1000 if most else 6
    links += [(0, 11, i, i + 1) for i in range(deep)] + [(0, 13, i + 1, i) for i in range(3)]
    seeds += [(0, 11, 0), (0, 13, 2), (7, 11, 4), (3, 11, -5)]
    for e in range(1, 30):
        links += [(e, rng.choice([11, 13]), rng.randrange(-3, 20), rng.randrange(-3, 20)) for _ in range(rng.randrange(40))]
        seeds += [(e, rng.choice([11, 13]), rng.randrange(20)) for _ in range(rng.randrange(3))]
    known = {}
    for e, f, m, c in links:
        known.setdefault((e, f, m), []).append((e, f, c))
    want, todo = set(), list(seeds)
    while todo:
        x = todo.pop()
        if x not in want:
            want.add(x)
            todo += known.get(x, [])
    a = spark.createDataFrame(links, "event_id long, flavor int, mother int, child int").repartition(6)
    b = spark.createDataFrame(seeds + seeds[:2], "event_id long, flavor int, idx int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = [tuple(r) for r in ancestry.spread_down(a, b, ("event_id", "flavor", "idx"), most_links=most).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(set(got)) and set(got) == want
    assert ancestry.spread_down(a.limit(0), b.limit(0), ("event_id", "flavor", "idx"), most_links=most).count() == 0


def test_earlier_max_over_ranges(spark):
    import random

    rng = random.Random(2)
    rows = [(i, rng.randrange(-300, 3000), rng.randrange(5000)) for i in range(400)] + [(400, 10**14, 1), (401, -(10**14), 7)]
    df = spark.createDataFrame(rows, "id long, at long, v long").repartition(5)
    got = {r["id"]: r["earlier_max"] for r in ordering.with_earlier_max(df, "at", "v", tie="id", width=50).collect()}
    most, want = None, {}
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        want[i] = most
        most = v if most is None else max(most, v)
    assert got == want
    plan = ordering.with_earlier_max(df, "at", "v", tie="id", width=50)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_long_files_are_hashed_in_pieces(spark, tmp_path):
    """Every task reads a part of a long file, and the digest is still that of the whole file."""
    import random

    noise = random.Random(7).randbytes(3_200_000)
    bodies = {
        "noise.parquet": noise, "ends.parquet": b"\n" + noise[:2_500_000] + b"\n\n", "mark.parquet": b"\xef\xbb\xbf" + noise[:2_000_000] + b"\n",
        "mark_open.parquet": b"\xef\xbb\xbf\n" + noise[:2_000_000] + b"x", "feeds.parquet": b"\n" * 1_500_000, "plain.parquet": b"\0" * 1_500_000, "odd[1]{a}.parquet": b"\r\n" * 700_000 + b"\xff",
        "packed.gz": noise[:1_200_000], "short.parquet": b"x\n",
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        long = f"file:{tmp_path}/noise.parquet"
        assert listing.chained_digests(spark, {long: len(noise)}) == {long: hashlib.sha256(noise).hexdigest()}
        got = {r.path.rsplit("/", 1)[1]: (r.length, r.content_sha256) for r in listing.content_fingerprints(spark, str(tmp_path), whole=1_000_000).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {name: (len(body), hashlib.sha256(body).hexdigest()) for name, body in bodies.items()}


def test_fingerprint_reads_odd_documents_as_before(spark):
    """Nulls, types, misfits and doubled jobs count; each document is read by one job alone."""
    from leptide.operators import audit

    docs = [
        (1, '{"a": {"x": 1, "y": null}, "b": "1"}'), (2, '{"a": {"x": 1, "y": null}, "b": 1}'), (3, '{"a": 5, "b": "1", "c": [1, {"z": 2}]}'),
        (4, '[{"a": {"x": 1}}]'), (5, None), (5, None), (6, '{"a": {"x": "NaN"}, "b": {"q": 1}}'),
    ]
    df = spark.createDataFrame(docs, "job_id long, document string")
    long, found = audit.fingerprint(df, ["a.x", "b"], ["a.y", "c"])
    got = sorted((r.job_id, r.path, r.value) for r in long.where("present").collect())
    assert got == [(1, "a.x", "1"), (1, "a.y", "null"), (1, "b", '"1"'), (2, "a.x", "1"), (2, "a.y", "null"), (2, "b", "1"),
                   (3, "b", '"1"'), (3, "c", '[1,{"z":2}]'), (6, "a.x", '"NaN"'), (6, "b", '{"q":1}')]
    rows = sorted((r.rule, r.subject) for r in found.collect())
    lost = [("fingerprint.missing", s) for s in ("3/a.x", "4/a.x", "4/b", "5/a.x", "5/a.x", "5/b", "5/b")]
    assert rows == [("fingerprint.differs", p) for p in ("a.x", "a.y", "b", "c")] + lost
    with pytest.raises(Exception):
        audit.fingerprint(df.unionByName(df.selectExpr("job_id", "'{\"a\": ' as document")), ["a.x"], ["b"])[1].collect()
    inner, _ = audit.fingerprint(df.where("job_id = 1"), ["a"], ["a.x"])
    assert sorted((r.path, r.value) for r in inner.collect()) == [("a", '{"x":1,"y":null}'), ("a.x", "1")]

    # one pass: the documents are parsed where they are first read, and the findings come from what that left
    wide = spark.range(2000).selectExpr("id as job_id", "to_json(named_struct('a', named_struct('x', 1), 'b', id % 2)) as document")
    plan = audit.fingerprint(wide, ["a.x", "b"], ["c"])[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan


def test_job_events_are_derived_in_many_tasks(spark):
    """A small file is one split; the rows of 255 columns are derived in many tasks, and none is lost."""
    from leptide import bridge
    from leptide.queries import aggregates

    sf = "/root/testdata/sf0.001"
    narrow = bridge.event_view(spark, sf, parts=6)
    assert narrow.rdd.getNumPartitions() == 6 and narrow.count() == bridge.event_view(spark, sf).count()
    assert "RepartitionByExpression" in aggregates._job_events(spark, sf)._jdf.queryExecution().analyzed().toString()


def _bare(spark, schema, n):
    """n rows of a schema with nothing but the keys, 250 a job."""
    keys = {"campaign_id": "20260902", "sample_code": "0", "job_id": "id div 250", "source_event_id": "id + 1"}
    return spark.range(n).select(*[F.expr(keys.get(f.name, "null")).cast(f.dataType).alias(f.name) for f in schema])


def test_wide_events_are_written_where_they_are_derived(spark, tmp_path):
    """Jobs lie together before the 255 columns are derived: what is moved has three columns, and each job is one file in order."""
    from leptide import bridge
    from leptide.plans import campaign_jobs
    from leptide.queries import aggregates
    from leptide.sinks.tables import event_schema

    narrow = bridge.event_view(spark, "/root/testdata/sf0.001", parts=6, whole_jobs=True)
    places = narrow.select("job_id", F.spark_partition_id().alias("p")).distinct()
    assert places.count() == places.select("job_id").distinct().count() > 1
    moved = campaign_jobs.events_by_job(aggregates._job_events(spark, "/root/testdata/sf0.001"), together=True)
    plan = moved._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.rindex("Generate")
    campaign_jobs.write_job_events(_bare(spark, event_schema(), 500).coalesce(1), str(tmp_path), together=True)
    files = list((tmp_path / "Events" / "job=job-20260902-0-1").glob("*.parquet"))
    assert len(files) == 1
    assert [r.source_event_id for r in spark.read.parquet(str(files[0])).select("source_event_id").collect()] == list(range(251, 501))


def test_kept_jobs_shuffle_no_events(spark, tmp_path):
    """Which jobs are good is broadcast, whatever Spark holds their number to be."""
    from leptide.plans import campaign_jobs
    from leptide.sinks.tables import event_schema, run_schema

    runs = _bare(spark, run_schema(), 500).dropDuplicates(["job_id"])
    campaign_jobs.write_job_events(_bare(spark, event_schema(), 500), str(tmp_path))
    campaign_jobs.write_job_records(runs, runs.selectExpr("campaign_id", "sample_code", "job_id", "'{\"a\": 1}' as document"), str(tmp_path))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        jobs = campaign_jobs.read_jobs(spark, str(tmp_path))
        assert "Exchange hashpartitioning" not in jobs.events._jdf.queryExecution().executedPlan().toString()
        assert jobs.events.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
