import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from seismiq.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits),
            "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    found = [(m.start(), n, m.end()) for n, k in enumerate(BASE) for m in re.finditer(BASE[k], text) if holds(k, m.group())]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


TEXTS = [
    "mail a.b+c@x-y.example.com, or a@b.c_d@e.f; @no.where a@b", "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 007.08.9.255 1.2.3", "pay 4111 1111 1111 1111 or 4111-1111-1111-1112",
    "+1 (555) 123-4567 and +49 89 1234567890123456 +1 23", "é漢😀 x@y.zz 😀 +44 20 7946 0958", "", None, "no data", "a@b.c" * 5, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2",
    "4111111111111111 4111111111111111", "..@..", "x@y..z 1.2..3.4", "-%+@a-.b-", "(+12345678 9)9.9.9.9",
]


def test_base_spans_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pii.with_base(docs).select("doc_id", "text", pii.listed(F.col("base")).alias("l")).collect():
        assert r["l"] == brute(r["text"] or ""), r["text"]


def test_base_spans_of_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = pii.with_base(docs).select("text", pii.listed(F.col("base")).alias("l")).collect()
    assert all(r["l"] == brute(r["text"]) for r in got) and any(r["l"] for r in got)


def test_runs_that_invite_backtracking_take_linear_time(spark):
    texts = ["a" * 200_000, "1" * 200_000, "a@" + "b." * 50_000, "+1" + "(" * 100_000, "1." * 60_000, "x" * 100_000 + "@"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert pii.find(docs).count() == len(texts)


def test_bootstrapping_finds_unseen_identifiers_by_their_context(spark):
    seeds = [f"please call +1 555 010 {i:04d} today" for i in range(8)]
    unseen = ["please call 0555/0199-77 today", "room 0555/0199-77 again", "build 20240101 passed", "version 20240101 and nothing else"]
    docs = spark.createDataFrame(list(enumerate(seeds + unseen)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs).select("doc_id", "base", "added", pii.listed(F.col("spans")).alias("l")).collect()}
    assert all(got[i]["l"].startswith("phone:12:") and not got[i]["added"] for i in range(8))
    assert got[8]["base"] == [] and got[8]["l"] == "phone:12:24"
    assert got[9]["l"] == "phone:5:17"  # the identifier is known now, wherever it stands
    assert got[10]["l"] == got[11]["l"] == ""


def test_patterns_score_instances_over_rounds(spark):
    rows = [(f"seed{i}", 3, p) for i in range(6) for p in ("call _ 9", "ring _ 9")]
    rows += [("new", None, "call _ 9"), ("new", None, "dial _ 9"), ("later", None, "dial _ 9"), ("never", None, "room _ 9")]
    rows += [(f"seed{i}", 3, "dial _ 9") for i in range(2)]
    got = {r["value"]: r["kind"] for r in pii.bootstrap(spark.createDataFrame(rows, "value string, kind int, pattern string")).collect()}
    # call: six of seven instances known, which one pattern alone is not sure enough of; dial: two of four, too few
    assert got == {}
    rows += [("new", None, "ring _ 9"), ("later", None, "ask _ 9")] + [(f"seed{i}", 3, "ask _ 9") for i in range(6)]
    got = {r["value"]: r["kind"] for r in pii.bootstrap(spark.createDataFrame(rows, "value string, kind int, pattern string")).collect()}
    assert got["new"] == 3 and "never" not in got


def test_redaction(spark):
    rows = [(1, "mail a@b.cc now 😀 10.0.0.1", 26, "k"), (2, "clean", 5, None), (3, None, None, None), (1, "mail a@b.cc now 😀 10.0.0.1", 26, "k"), (None, "x@y.zz", 6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, base string")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        (1, "mail [EMAIL] now 😀 [IP]", 23, "k"), (1, "mail [EMAIL] now 😀 [IP]", 23, "k"), (2, "clean", 5, None), (3, None, None, None), (None, "[EMAIL]", 7, None)], key=str)
    assert pii.redact(docs.limit(0)).count() == 0
    assert pii.find(docs.limit(0)).count() == 0


def test_digest_of_no_spans(spark):
    docs = spark.createDataFrame([(1, "none")], "doc_id long, text string")
    from seismiq.llm.common import sha256_hex
    assert pii.find(docs).select(sha256_hex(pii.listed(F.col("base")))).first()[0] == hashlib.sha256(b"").hexdigest()


def test_numbers_in_groups_are_found_as_a_whole(spark):
    seeds = [f"my tel +1 555 010 {i:04d} today" for i in range(12)]
    unseen = ["my tel 555 123 4567 now", "my tel (555) 123-4567 now", "my tel [555] 123.4568, then", "ward 555 123 4567 too", "rows 1 2 3 and 4567 more"]
    docs = spark.createDataFrame(list(enumerate(seeds + unseen)), "doc_id long, text string")
    got = {r["doc_id"]: r["l"] for r in pii.find(docs).select("doc_id", pii.listed(F.col("spans")).alias("l")).collect()}
    assert [got[12 + k] for k in range(5)] == ["phone:7:19", "phone:7:21", "phone:7:21", "phone:5:17", ""]
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[13] == "my tel [PHONE] now"


def test_the_context_is_the_text_before_whatever_stands_in_it(spark):
    rows = [("id 7 phone 0555/0199",), ("one +1 555 010 0001 or +1 555 010 0002",)]
    marked = pii.with_base(spark.createDataFrame(rows, "text string"))
    marked = marked.withColumn("tokens", pii._tokens(F.col("text"), F.col("base"))).collect()
    assert [(s["value"], s["before"]) for s in marked[0]["tokens"]] == [("0555/0199", "id 7 phone ")]
    assert [s["before"] for s in marked[1]["base"]] == ["one ", "one +1 555 010 0001 or "]


def brute_bootstrap(rows):
    """The same graph in plain Python: (value, kind, pattern or None)."""
    pairs = Counter((p, v) for v, _, p in rows)
    known = {}
    for v, k, _ in rows:
        if k is not None:
            known[v] = min(k, known.get(v, 9))
    found = set()
    while True:
        sure = {}
        for p in {p for p, _ in pairs}:
            values = [v for q, v in pairs if q == p]
            by = Counter(known[v] for v in values if v in known)
            if by:
                support = max(by.values())
                kind = min(k for k in by if by[k] == support)
                if support >= pii.LEAST_SUPPORT and support / len(values) >= pii.LEAST_SHARE:
                    sure[p] = (kind, support / len(values) * support / (support + 1))
        new, here = {}, set()
        for v in {v for _, v in pairs} - known.keys():
            total = sum(n for (_, w), n in pairs.items() if w == v)
            best = None
            for k in range(len(pii.ALL_KINDS)):
                own = [p for p, w in pairs if w == v and sure.get(p, (None,))[0] == k]
                belief = 1 - math.prod(1 - sure[p][1] for p in own)
                if own and (best is None or belief > best[0] + 1e-12):
                    best = (belief, k, own)
            if best and best[0] >= pii.LEAST_BELIEF:
                if sum(pairs[p, v] for p in best[2]) >= pii.LEAST_SHARE * total:
                    new[v] = best[1]
                else:
                    here |= {(v, best[1], p) for p in best[2]}
        if not new:
            return found | here
        known |= new
        found |= {(v, k, None) for v, k in new.items()}


def test_bootstrap_equals_brute_force(spark):
    rng = random.Random(4)
    seen = 0
    for _ in range(4):
        rows = []
        for n in range(90):
            kind = rng.choice([None, None, 3, 4])
            for _ in range(rng.randint(1, 6)):
                rows.append((f"v{n}", kind, f"p{rng.randrange(5) + 5 * (kind or rng.choice([3, 4, 9]))}"))
        got = {tuple(r) for r in pii.bootstrap(spark.createDataFrame(rows, "value string, kind int, pattern string")).collect()}
        assert got == brute_bootstrap(rows)
        seen += len(got)
    assert seen > 20


def test_a_chain_of_contexts_is_followed_to_its_end(spark):
    """Each link is found only after the one before: seven rounds."""
    rows = [(f"seed{i}", 3, p) for i in range(9) for p in ("a0 _9", "b0 _9", "c0 _9", "d0 _9")]
    for k in range(7):
        rows += [(f"link{k}.{i}", None, f"{x}{k + d} _9") for i in range(3) for d in (0, 1) for x in "abcd"]
    got = {r["value"] for r in pii.bootstrap(spark.createDataFrame(rows, "value string, kind int, pattern string")).collect()}
    assert got == {f"link{k}.{i}" for k in range(7) for i in range(3)}


def test_one_confident_context_does_not_label_a_value_that_stands_elsewhere(spark):
    texts = [f"please call +1 555 010 {i:04d} today" for i in range(8)] + ["please call 2024 today"]
    texts += [f"report {i} of the year 2024 was fine" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert all(clean[i] == texts[i] for i in range(9, 69))
    assert clean[8] == "please call [PHONE] today" and clean[0] == "please call [PHONE] today"


def test_secrets_are_seeds_and_their_contexts_find_more(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(8)]
    texts = [f'set token = "{h}"!! now' for h in hexes[:6]]
    texts += [f"set token = {hexes[6]} now", f"seen {hexes[0]} again", f"commit {hexes[7]} merged", 'name = "plain words that are quoted"']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs).select("doc_id", "base", pii.listed(F.col("spans")).alias("l")).collect()}
    assert all(got[i]["l"] == "secret:13:53" and not got[i]["base"] for i in range(6))
    assert [got[i]["l"] for i in range(6, 10)] == ["secret:12:52", "secret:5:45", "", ""]
    assert pii.redact(docs).where("doc_id = 0").first()["text"] == 'set token = "[SECRET]"!! now'


def test_long_words_and_gaps_leave_the_context_as_it_is(spark):
    rows = [("please" + " " * 500 + "call" + "\n" * 90 + "0555/0199",), ("x" * 90_000 + "please call 0555/0199",), ("y" * 700 + "please call 0555/0199",)]
    marked = pii.with_base(spark.createDataFrame(rows, "text string")).withColumn("tokens", pii._tokens(F.col("text"), F.col("base")))
    s = F.col("tokens")[0]
    got = [r["c"] for r in marked.select(pii._contexts(s["before"], s["value"]).alias("c")).collect()]
    assert got[0] == ["call _9", "please call _9"] and got[1][0] == got[2][0] == "call _9"
    assert got[1][1] == "x" * 18 + "please call _9" and got[2][1] == "y" * 18 + "please call _9"


def test_redaction_of_a_table_with_clashing_columns(spark):
    names = ("__id", "__key", "__spans", "__text_key", "key", "found_id", "c0", "clean")
    docs = spark.createDataFrame([(1, "mail a@b.cc", *range(len(names)))], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    out = pii.redact(docs)
    assert out.columns == docs.columns and tuple(out.first()) == (1, "mail [EMAIL]", *range(len(names)))
