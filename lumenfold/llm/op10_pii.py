"""Personal data: base patterns, and a skip-chain conditional random field that carries their labels to other mentions.

A document's candidates (numbers, dotted groups, addresses, with spelled-out forms of "@" too) are the nodes. Neighbours in
the text share chain potentials; candidates with the same key (last digits of a number, name and host of an address) and those
with a similar one (fewer last digits, the same network, the same host) share skip potentials with the next such candidate,
however far off, so a group of n mentions has n - 1 edges. Loopy sum-product passes messages until the labels of a document
agree. Nodes on a base span are held at its kind.

Training is piecewise: node weights by multinomial logistic regression of the base labels on shape features, and the potentials of
the three sorts of edges from counts of the label pairs that they join, on the labelled ones (those with a base span) of a bounded
sample of TRAIN_ROWS documents (at most TRAIN_NODES nodes). A node that is not on a base span becomes a new span if its kind has a posterior of MIN_POSTERIOR or more;
nothing but the field decides that. A document without base spans is a graph like the others: its nodes are judged by their shape,
context and neighbours. Base spans always stay.

Cases: null text is empty; a text without candidates has empty span lists; rows may repeat; extra columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumenfold.llm.common import table

KINDS = ["email", "ip", "card", "phone"]
TRAIN_ROWS, TRAIN_NODES, ROUNDS, MIN_POSTERIOR = 4000, 50_000, 8, 0.9
# possessive or anchored forms of the base patterns: the same leftmost matches, in time linear in the text
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NUMBER = re.compile(r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9])+")
# a name is tried at its first character only and taken whole, so that a long run of letters is read once
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[({] ?(?:at|AT) ?[\])}] ?| (?:at|AT) |@)[A-Za-z0-9-]++(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?| (?:dot|DOT) )[A-Za-z0-9-]++)+")
HINTS = {"phone": 0, "tel": 0, "call": 0, "fax": 0, "mobile": 0, "email": 1, "mail": 1, "contact": 1, "card": 2, "visa": 2, "ip": 3, "host": 3,
         "server": 3, "address": 3}
FEATURES = 32
#: Sorts of edges, and the bound of their potentials: nodes that only stand side by side say little about each other.
SORTS, NODE = {"chain": 1.0, "same": 5.0, "similar": 3.0}, 3
PRIOR = {"chain": 0.0, "same": 40.0, "similar": 4.0}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches."""
    out, end = [], 0
    if "@" in text:
        for m in HOST.finditer(text):
            i = m.start()
            while i > end and text[i - 1] in LOCAL_CHARS:
                i -= 1
            if i < m.start():
                out.append((i, 0, m.end()))
                end = m.end()
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = digits_of(m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


def key_of(s: str) -> str:
    if any(c.isalpha() for c in s):
        s = re.sub(r" ?[\[({]? ?\b(at|AT)\b ?[\])}]? ?", "@", s)
        return re.sub(r" ?[\[({]? ?\b(dot|DOT)\b ?[\])}]? ?", ".", s).lower()
    parts = re.findall("[0-9]+", s)
    return ".".join(str(int(p)) for p in parts) if len(parts) == 4 and all(len(p) <= 3 for p in parts) else digits_of(s)[-9:]


def likeness(key: str) -> str:
    """What similar keys have in common: the host of an address, the network of a dotted group, the last six digits."""
    if "@" in key:
        return key[key.index("@"):]
    return key[:key.rindex(".") + 1] if "." in key else key[-6:]


def nodes(text: str, base) -> list[tuple[int, int, int]]:
    """(start, end, kind or -1) of the candidates of a text, base spans among them."""
    out, taken = [(a, b, k) for a, k, b in base], [(a, b) for a, _, b in base]
    for pattern in (SPELLED, NUMBER):
        for m in pattern.finditer(text):
            if pattern is SPELLED or sum(map(str.isdigit, m[0])) >= 4:
                out.append((m.start(), m.end(), -1))
    # base spans first, then the earliest and longest candidate of those that overlap
    kept, last = [], -1
    edges = np.array(sorted(taken)).reshape(-1, 2)
    reach = np.maximum.accumulate(edges[:, 1])
    for a, b, k in sorted(out, key=lambda x: (x[0], -x[2], -x[1])):
        if k < 0:
            i = np.searchsorted(edges[:, 0], b)
            if a < last or (i > 0 and reach[i - 1] > a):
                continue
            last = b
        kept.append((a, b, k))
    return kept


def features(text: str, a: int, b: int) -> list[int]:
    """Shape and context; the marks that the base patterns demand (a plus, an @, a check digit) are left out, as other mentions lack them."""
    s = text[a:b]
    d = sum("0" <= c <= "9" for c in s)
    own = [0, 1 + int(np.searchsorted([4, 7, 10, 12, 14, 17, 20], d, "right")), 9 + min(4, s.count(".")), 14 + (" " in s), 16 + ("-" in s),
           18 + any(c.isalpha() for c in s)]
    for w in re.findall(r"[a-z]+", text[max(0, a - 24):a].lower())[-2:]:
        if w in HINTS:
            own.append(26 + HINTS[w])
    return own


def graph(texts: list[str]):
    """Nodes and edges of all documents: base spans per text, and (rows, spans, kinds, features, keys, edges by sort)."""
    bases, rows, spans, kinds, shape, keys, edges = [], [], [], [], [], [], ([], [], [])
    for r, text in enumerate(texts):
        base = base_spans(text)
        bases.append(base)
        last: dict[str, int] = {}
        alike: dict[str, int] = {}
        for j, (a, b, k) in enumerate(nodes(text, base)):
            i, key = len(rows), key_of(text[a:b])
            if j:
                edges[0].append((i - 1, i))
            if key in last:
                edges[1].append((last[key], i))
            near = likeness(key)
            if near in alike and keys[alike[near]] != key:
                edges[2].append((alike[near], i))
            last[key] = alike[near] = i
            rows.append(r)
            spans.append((a, b))
            kinds.append(k)
            shape.append(features(text, a, b))
            keys.append(key)
    return bases, rows, spans, np.array(kinds, int), shape, keys, [np.array(e, int).reshape(-1, 2) for e in edges]


def dense(shape) -> np.ndarray:
    x = np.zeros((len(shape), FEATURES))
    for i, f in enumerate(shape):
        x[i, f] = 1
    return x


def softmax(x: np.ndarray, axis: int = -1) -> np.ndarray:
    e = np.exp(x - x.max(axis, keepdims=True))
    return e / e.sum(axis, keepdims=True)


def beliefs(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product in the log domain with damping: marginals of nodes (n x labels); potentials are per edge."""
    both = np.concatenate([edges, edges[:, ::-1]])
    pot = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    n, sent = len(edges), np.zeros((2 * len(edges), unary.shape[1]))
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, both[:, 1], sent)
        out = (total[both[:, 0]] - sent[back])[:, :, None] + pot
        top = out.max(1)
        out = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        sent = 0.5 * sent + 0.5 * (out - out.mean(1, keepdims=True))
    np.add.at(unary := unary.copy(), both[:, 1], sent)
    return softmax(unary)


def _train_rows(batches):
    for batch in batches:
        # without a label in its document, a mention is unknown too
        _, rows, _, kinds, shape, keys, edges = graph([t for t in (x.as_py() or "" for x in batch.column("text")) if base_spans(t)])
        kinds = kinds + 1
        # a mention without base label whose key a base span has is unknown, not a counterexample
        known = {(rows[i], keys[i]) for i in np.flatnonzero(kinds > 0)}
        use = [bool(kinds[i]) or (rows[i], keys[i]) not in known for i in range(len(kinds))]
        pairs = [(c, int(kinds[i]), int(kinds[j])) for c, e in enumerate(edges) for i, j in e if use[i] and use[j]]
        shape = [x for x, u in zip(shape, use) if u]
        kinds = kinds[np.array(use, bool)]
        n, m = len(kinds), len(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([NODE] * n + [p[0] for p in pairs], pa.int32()), pa.array([*kinds.tolist(), *[p[1] for p in pairs]], pa.int32()),
             pa.array([0] * n + [p[2] for p in pairs], pa.int32()), pa.array([",".join(map(str, sorted(s))) for s in shape] + [""] * m)],
            ["what", "x", "y", "shape"])


def train(docs: DataFrame, steps: int = 300, ridge: float = 3e-2) -> dict[str, np.ndarray]:
    """Node weights (features x labels) and log potentials of label pairs (labels x labels; label 0 is none)."""
    n = docs.count()
    share = min(1.0, TRAIN_ROWS / max(1, n))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    counts = sample.select("text").mapInArrow(_train_rows, "what int, x int, y int, shape string").groupBy("what", "x", "y", "shape").count()
    rows = counts.orderBy(F.desc("what"), F.desc("count"), "x", "y", "shape").limit(TRAIN_NODES).collect()
    k = len(KINDS) + 1
    # potentials are pointwise mutual information of the labels at both ends; before any data, every pair was seen once and
    # pairs that agree as often as PRIOR says, so that a corpus with few repeated mentions still has a field
    pairs = 1 + np.array(list(PRIOR.values()))[:, None, None] * np.eye(k)
    for r in rows:
        if r.what != NODE:
            pairs[r.what, r.x, r.y] += r["count"]
    pairs = pairs + pairs.transpose(0, 2, 1)
    own = pairs.sum(2)
    log = np.log(pairs * own.sum(1)[:, None, None] / (own[:, :, None] * own[:, None, :]))
    weights = np.zeros((FEATURES, k))
    node = [r for r in rows if r.what == NODE]
    if node:
        x, y = dense([list(map(int, r["shape"].split(","))) for r in node]), np.eye(k)[[r.x for r in node]]
        c = np.array([r["count"] for r in node], float)
        c /= c.sum()
        for _ in range(steps):
            weights -= 2.0 * (x.T @ ((softmax(x @ weights) - y) * c[:, None]) + ridge * weights)
    return {"weights": weights, **{sort: np.clip(x, -bound, bound) for (sort, bound), x in zip(SORTS.items(), log)}}


def posterior(model: dict, kinds: np.ndarray, shape: list, edges: list, sorts=tuple(SORTS)) -> np.ndarray:
    """Marginals of the nodes (n x labels) with the given sorts of edges; kinds of 0 and more are held."""
    unary = dense(shape) @ model["weights"]
    held = kinds >= 0
    unary[held] = np.where(np.arange(unary.shape[1]) == kinds[held][:, None] + 1, 0.0, -30.0)
    used = [(e, model[sort]) for sort, e in zip(SORTS, edges) if sort in sorts]
    return beliefs(unary, np.concatenate([e for e, _ in used]), np.concatenate([np.repeat(x[None], len(e), 0) for e, x in used]))


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def finder(model):
    def find(batches):
        m = model.value
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column("text")]
            bases, rows, spans, kinds, shape, _, edges = graph(texts)
            every = [list(b) for b in bases]
            if rows:
                p = posterior(m, kinds, shape, edges)
                for i in np.flatnonzero((kinds < 0) & (p[:, 1:].max(1) >= MIN_POSTERIOR)):
                    every[rows[i]].append((spans[i][0], int(p[i, 1:].argmax()), spans[i][1]))
            counts = [[sum(k == x for _, k, _ in b) for b in bases] for x in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in bases]), pa.array([listed(e) for e in every])],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return find


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows) if model is None else model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(finder(model), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op10(spark, sf_dir) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {"op10_personal_data": op10}
