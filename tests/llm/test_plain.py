"""Plain re-implementations: the convolutional network's forward pass by loops, and novel secrets by a search of the whole text, over texts with planted ones."""

from __future__ import annotations

import math
import random
import string

import numpy as np

from kbweave.llm import quality_cnn, secrets

SF = "/root/testdata/sf0.001"


def plain_score(text, net):
    """One window, chunk and filter at a time."""
    s = net.settings
    n = max(1, math.ceil(max(len(text) - s.width, 0) / s.stride) + 1)
    padded = text + b"\0" * ((n - 1) * s.stride + s.width - len(text))
    rows = []
    for k in range(n):
        flat = np.concatenate([net.table[b] for b in padded[k * s.stride : k * s.stride + s.width]])
        rows.append([max(0.0, float(flat @ net.kernel[:, f]) + float(net.bias[f])) for f in range(s.filters)])
    chunks, begin = [], 0
    while True:
        chunks.append([max(r[f] for r in rows[begin : begin + s.chunk]) for f in range(s.filters)])
        if begin + s.chunk >= n:
            break
        begin += s.hop
    features = [sum(c[f] for c in chunks) / len(chunks) for f in range(s.filters)] + [max(c[f] for c in chunks) for f in range(s.filters)] + [1.0]
    return 1 / (1 + math.exp(-sum(x * float(w) for x, w in zip(features, net.out, strict=True))))


def test_forward_pass_by_loops():
    rng = random.Random(2)
    rows = [(b"plain words of a text " * 6, 1), (b"#%% noise && !! " * 9, 0)] * 12
    net = quality_cnn.train(rows, quality_cnn.Settings(epochs=2))
    texts = [b"", b"a", b"exactly sixteen!", "é ß 漢字".encode() * 30, bytes(rng.randrange(1, 256) for _ in range(1500)), b"plain words " * 150]
    got = quality_cnn.score(texts, net)
    assert np.allclose(got, [plain_score(t, net) for t in texts], atol=1e-5)
    assert np.allclose(quality_cnn.score(texts, net, block=96), got, atol=1e-5)


def test_gradients_by_finite_differences():
    """A step of training moves every weight against the slope of the weighted loss, measured by small changes."""
    s = quality_cnn.Settings(epochs=1, batch=4, rate=1e-3, filters=4, embedding=3)
    rows = [(b"good text here " * 4, 1), (b"$$ bad %% " * 5, 0), (b"other fine words " * 3, 1), (b"&& junk ## " * 4, 0)]
    after = quality_cnn.train(rows, s)
    start = quality_cnn.train(rows, quality_cnn.Settings(epochs=0, batch=4, filters=4, embedding=3))

    def loss(net):
        p = np.clip(quality_cnn.score([t for t, _ in rows], net), 1e-9, 1 - 1e-9)
        y = np.asarray([y for _, y in rows])
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    rng = np.random.default_rng(1)
    checked = 0
    for name in ("kernel", "out", "bias"):
        weights, moved = getattr(start, name), getattr(after, name) - getattr(start, name)
        for at in rng.permutation(weights.size)[:12]:
            k = np.unravel_index(at, weights.shape)
            was = weights[k]
            weights[k] = was + 3e-2
            high = loss(start)
            weights[k] = was - 3e-2
            low = loss(start)
            weights[k] = was
            slope = (high - low) / 6e-2
            if abs(slope) > 3e-3:  # the first step of the optimizer goes by the sign
                checked += 1
                assert np.sign(moved[k]) == -np.sign(slope)
    assert checked >= 8


def plain_novel(data, settings, meter):
    taken = list(secrets.base_spans(data))
    words = [m.span() for m in secrets.SENSITIVE.finditer(data.lower())]
    out = set()
    for m in secrets.CANDIDATE.finditer(data):
        body = m.group().strip(b"!@$%^*~=-")
        if len(body) < settings.min_length:
            continue
        start = m.start() + m.group().index(body)
        end = start + len(body)
        kinds = sum([any(c in string.ascii_uppercase.encode() for c in body), any(c in string.ascii_lowercase.encode() for c in body), any(c in string.digits.encode() for c in body)])
        near = any(e <= start <= e + settings.context or end <= s <= end + settings.context for s, e in words)
        if kinds < settings.min_classes or not near or any(s < end and start < e for s, _, e in taken):
            continue
        least = settings.short_ratio if len(body) < settings.short_length else settings.min_ratio
        if meter(data[max(0, start - settings.context) : start], body, data[end : end + settings.context]) >= least:
            out.add((start, 3, end))
    return out


def test_planted_secrets_equal_the_plain_search(spark):
    rng = random.Random(9)
    random_value = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    said = ["the authorization header carries {}", "client id {} signs", "private key: {}", "{} is the passphrase", "bearer {}", "our credential ({})", "ordinary words {} here"]
    rows, planted = [], 0
    for k, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").select("text").orderBy("doc_id").collect()):
        words = (r["text"] or "").split(" ")
        for _ in range(k % 3):
            words.insert(rng.randrange(len(words) + 1), rng.choice(said).format(random_value(rng.randint(12, 48))))
            planted += 1
        rows.append((k, " ".join(words)))
    settings = secrets.Novelty()
    meter = secrets.novelty_meter(settings)
    found = secrets.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "secrets.spans").collect()
    by_id = dict(rows)
    total = 0
    for r in found:
        data = by_id[r["doc_id"]].encode()
        want = {(len(data[:s].decode()), len(data[:e].decode())) for s, _, e in plain_novel(data, settings, meter)}
        assert {(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "novel"} == want
        total += len(want)
    assert total > 0.6 * planted
