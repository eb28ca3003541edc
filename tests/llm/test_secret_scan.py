import hashlib
import re

from tessera.llm import secret_scan as ss

RX = {  # letters in either case are ASCII letters
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
TEXTS = [
    None, "", "nothing", 'password = "hunter2secret" and Token:abc token:abcdef', "é AKIA" + "Q7" * 9 + " AKIASHORT", "x" + "0af3" * 8 + "g", "secret: token = abcdefg", "secret=token=abcdefgh",
    "API_KEY='k.e-y/+=_9' apikey:12345 apikey:123456", "passwd :  " + "z" * 30_000, "ſecret=abcdefgh toKen=abcdefgh", " ".join(f"token={'a' * i}" for i in range(40)), "AKIAAKIA" + "0" * 20, "password=x\npassword=abcdef",
]


def brute(t):
    spans = []
    for k, (name, (rx, g, least)) in enumerate(RX.items()):
        spans += [(m.start(), k, m.end(), name) for m in rx.finditer(t or "") if len(m.group(g)) >= least]
    spans.sort()
    return spans


def test_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(99, TEXTS[3]), (None, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rule", "2 as blob_id").repartition(4)
    got = {}
    for r in ss.scan(docs).collect():
        got[r.doc_id] = (r.n_assign, r.n_access, r.n_hex, r.spans, r.base_sha256)
    for d, t in rows:
        s = brute(t)
        joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in s)
        assert got[d] == (*(sum(x[3] == n for x in s) for n in RX), joined, hashlib.sha256(joined.encode()).hexdigest()), d
    assert ss.scan(docs.limit(0)).count() == 0


def test_ledger_scans_only_new_pairs(spark):
    one = spark.createDataFrame([("a/1", TEXTS[3]), ("b/1", "clean"), ("c/1", TEXTS[3])], "path string, text string")
    ledger = ss.update_ledger(one)
    assert ledger.count() == 2 * 3
    rows = ledger.collect()
    ledger = spark.createDataFrame(rows, ss.LEDGER_SCHEMA)
    two = one.unionByName(spark.createDataFrame([("a/2", TEXTS[5])], "path string, text string"))
    new = ss.update_ledger(two, ledger)
    assert {(r.rule, r.version) for r in new.collect()} == {(r.name, 1) for r in ss.BASE_RULES} and new.count() == 3
    newer = (ss.BASE_RULES[0], ss.Rule("hex", 2, r"[0-9a-f]{24,}", 0, 24))
    again = ss.update_ledger(one, ledger, newer)
    assert {(r.rule, r.version) for r in again.collect()} == {("hex", 2)} and again.count() == 2
    full = ledger.unionByName(new)
    paths = {(r.path, r.rule, r.start, r.end) for r in ss.paths_with_spans(two, full).collect()}
    assert {p for p, *_ in paths} == {"a/1", "c/1", "a/2"}
    assert {(a, b) for p, _, a, b in paths if p == "c/1"} == {(a, b) for a, _, b, _ in brute(TEXTS[3])}


def test_scan_goes_through_a_stored_ledger(spark, monkeypatch):
    asked, made, update = [], [], ss.update_ledger
    monkeypatch.setattr(ss, "update_ledger", lambda versions, ledger, rules: asked.append(ledger) or made.append(update(versions, ledger, rules)) or made[-1])
    texts = [*TEXTS, TEXTS[3], "only later token=abcdefgh"]
    docs = spark.createDataFrame([*enumerate(TEXTS), (100, texts[-2]), (101, texts[-1])], "doc_id long, text string")
    rows = sorted(ss.scan(docs).collect())
    assert asked[0] is None and asked[1] is not None and len(made) == 2
    first, second = ({(bytes(r.blob_id), r.rule) for r in m.collect()} for m in made)
    assert first and second and not first & second  # nothing is scanned twice
    assert len(second) == 3 and len(first | second) == 3 * len({t or "" for t in texts})
    assert [r.n_assign + r.n_access + r.n_hex for r in rows] == [len(brute(t)) for t in texts]


def test_known_texts_are_not_moved(spark):
    one = spark.createDataFrame([(i, f"known {i} token=abcdef{i}") for i in range(300)], "doc_id long, text string")
    two = one.unionByName(spark.createDataFrame([(1000, "new password=hunter22"), (1001, "new password=hunter22")], "doc_id long, text string"))
    ledger = ss.stage(ss.update_ledger(one), "ledger")
    assert ss.pairs_to_scan(two, ledger, ss.BASE_RULES).count() == 1
    for bound in (10, 0):  # sent to the texts, dealt by id
        assert [r.text for r in ss.new_blobs(two, ledger, ss.BASE_RULES, bound).collect()] == ["new password=hunter22"]
    plan = ss.new_blobs(two, ledger, ss.BASE_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    below = plan[plan.index("BroadcastHashJoin") :]  # no exchange of texts before the known ones are gone
    assert "Exchange hashpartitioning" not in below
    for ids in (ss.pairs_to_scan(two, ledger, ss.BASE_RULES), ss.pairs_to_scan(one, ledger, ss.BASE_RULES)):
        assert all("text" not in line for line in ids._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line)


def test_very_long_texts(spark):
    filler = "nothing to see here " * 60_000
    texts = [filler + "token=abcdef1 " + filler + "AKIA" + "Z" * 30, "0" * 1_000_000, "password=" + "x" * 500_000]
    got = {r.doc_id: r for r in ss.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i].spans == ",".join(f"{n}:{a}:{b}" for a, _, b, n in brute(t))
