import hashlib
import random
import re
import time

import numpy as np

from lumenfold.llm.op10_pii import MIN_POSTERIOR, SPELLED, beliefs, base_spans, graph, listed, nodes, personal_data, posterior, train

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    found = []
    for n, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c.isdigit()]
            total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                  "card": 14 <= len(d) <= 19 and total % 10 == 0, "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                found.append((m.start(), n, m.end()))
    return ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found))


TEXTS = ["mail a.b@x-y.co and @no.pe or q@a.b@c.d.e end", "ips 1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.255 9.9.9", "4111 1111 1111 1111 and 4111-1111-1111-1112",
         "call +49 (30) 123-4567 89 or +1 2 or +1234567890123456789", "12 4111111111111111 x+49301234567.", "é😀 a@b.c, +4930 1234567", "", "@@a.b", "1" * 5000,
         "+" * 50 + "1 (((" + "a@b.c" * 30, "x" * 3000 + "@y.z"]


def test_base_matches_plain_patterns(spark, small):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for t in texts:
        assert listed(base_spans(t)) == plain(t), t[:80]


def test_query_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("*", "1 as spans")
    extra = spark.createDataFrame([(900001, None), (None, "")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    want = {r.doc_id: plain(r.text or "") for r in rows.collect()}
    out = personal_data(rows).collect()
    assert len(out) == len(want)
    for r in out:
        base = want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_email == base.count("email:") and r.n_phone == base.count("phone:")
        assert set(filter(None, base.split(","))) <= set(filter(None, r.spans.split(",")))


def test_other_mentions_get_the_label(spark, small):
    """Mentions in another form take the kind of the base span they repeat; unrelated numbers stay free."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    own = [(1000001, "Call +49 30 1234567 today. Later: 030/1234567 again, order 99887766554 remains. Host 10.20.30.40 also 10-20-30-40."),
           (1000002, "Write to jane.doe@example.org or jane.doe at example dot org."), (1000003, "order 1234567 and 030/1234567 only")]
    out = {r.doc_id: r.spans for r in personal_data(docs.union(spark.createDataFrame(own, docs.schema))).collect()}
    assert "phone:34:45" in out[1000001] and "99887766554" not in own[0][1][slice(*map(int, out[1000001].split(",")[-1].split(":")[1:]))]
    assert "email:33" in out[1000002]
    assert out[1000003] == ""


def test_empty_table(spark):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def mentions(seed, n):
    """Texts with a base mention of each kind, a second one that the base patterns miss, and numbers of other things; and the spans wanted."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        phone = "".join(rng.choice("123456789") for _ in range(9))
        name, host = rng.choice(["jane", "omar", "li.wei"]) + str(rng.randrange(99)), rng.choice(["mail.org", "corp.example.net"])
        a, b, c = rng.randrange(1, 255), rng.randrange(1, 255), rng.randrange(1, 255)
        parts = [("Call ", None), (f"+49 {phone[:2]} {phone[2:]}", None), (" or later ", None), (f"0{phone[:2]}/{phone[2:]}", 3), (". Order ", None),
                 ("".join(rng.choice("0123456789") for _ in range(rng.randrange(5, 12))), None), (" came. Mail ", None), (f"{name}@{host}", None), (" that is ", None),
                 (f"{name} at {host.replace('.', ' dot ')}", 0), (f" , host 10.{a}.{b}.{c} or ", None), (f"10-{a}-{b}-{c}", 1), (" pages 1200-1300.", None)]
        text, want = "", set()
        for part, kind in parts:
            if kind is not None:
                want.add((len(text), kind, len(text) + len(part)))
            text += part
        out.append((text, want))
    return out


def found(model, texts, **options):
    bases, rows, spans, kinds, shape, _, edges = graph(texts)
    p = posterior(model, kinds, shape, edges, **options)
    new = [set() for _ in texts]
    for i in np.flatnonzero((kinds < 0) & (p[:, 1:].max(1) >= MIN_POSTERIOR)):
        new[rows[i]].add((spans[i][0], int(p[i, 1:].argmax()), spans[i][1]))
    return new


def test_the_field_decides_on_masked_mentions(spark, small):
    """Precision and recall of added spans with a model of the table; without the distant edges almost all are lost."""
    model = train(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"))
    cases = mentions(3, 150)
    got, wanted = found(model, [t for t, _ in cases]), [w for _, w in cases]
    right, total, missed = sum(len(g & w) for g, w in zip(got, wanted)), sum(map(len, got)), sum(map(len, wanted))
    assert right >= 0.95 * total and right >= 0.9 * missed
    alone = found(model, [t for t, _ in cases], sorts=("chain",))
    assert sum(len(g & w) for g, w in zip(alone, wanted)) <= 0.1 * missed


def test_documents_without_base_spans_are_judged_too(spark, small):
    """Addresses that are only spelled out: the field has them as nodes, and what it takes for personal data comes out."""
    texts = ["Write to email jane.doe at example dot org. Or mail: jane.doe (at) example (dot) org, contact email jane.doe at example dot org!", "page 12 of 300", ""]
    assert not any(map(base_spans, texts))
    bases, rows, _, kinds, shape, _, edges = graph(texts)
    assert rows == [0, 0, 0] and (kinds < 0).all() and len(edges[1]) == 2
    model = train(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"))
    # whatever the text alone says about an address: a model that is sure of it adds the spans
    sure = {**model, "weights": np.eye(5)[1] * 20 + 0 * model["weights"]}
    out = {r.doc_id: r for r in personal_data(spark.createDataFrame(enumerate(texts), "doc_id long, text string"), model=sure).collect()}
    assert out[0].spans.count("email:") == 3 and out[0].n_email == 0 and out[1].spans == out[2].spans == ""
    assert all(p > 0 for p in posterior(model, kinds, shape, edges)[:, 1])


def test_messages_against_all_labellings():
    """On a chain of four nodes the marginals are exact."""
    rng = np.random.default_rng(1)
    unary, pot, edges = rng.normal(size=(4, 3)), rng.normal(size=(3, 3, 3)), np.array([[0, 1], [1, 2], [2, 3]])
    want = np.zeros((4, 3))
    for labels in np.ndindex(3, 3, 3, 3):
        p = np.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(pot[e, labels[a], labels[b]] for e, (a, b) in enumerate(edges)))
        want[np.arange(4), labels] += p
    assert np.allclose(beliefs(unary, edges, pot, 200), want / want.sum(1, keepdims=True), atol=1e-6)


def test_long_runs_are_read_once():
    for text in ("a@b.co " + "x" * 400_000, "a@b.co " + "x at " * 100_000, "a@b.co " + "1 " * 200_000, "a.b@c.de " * 20_000, "a@" + "b" * 300_000):
        start = time.process_time()
        nodes(text, base_spans(text))
        assert time.process_time() - start < 5
    assert [m[0] for m in SPELLED.finditer("x y.z at host dot org, q@r.st")] == ["y.z at host dot org", "q@r.st"]
