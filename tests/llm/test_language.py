"""The network's gradients and convolution against plain loops, and held-out accuracy."""

import numpy as np
import pytest


from tidelake.llm.language import _gradients, _softmax, identify, predict, sample, train, windows
from tidelake.llm.queries import op8_language

EN, FR = "the thing with the shape of that ", "le château près de l'été où "
SCHEMA = "doc_id bigint, text string, lang string, source string, score int"


@pytest.fixture(scope="module")
def net():
    return train([(EN * 8, "en"), (FR * 8, "fr")] * 40, epochs=2)


def slow_forward(net, window):
    e = net.embedding[window]
    h = []
    for filters, bias in zip(net.filters, net.biases, strict=True):
        w = len(filters)
        z = [sum(e[p + k] @ filters[k] for k in range(w)) + bias for p in range(len(window) - w + 1)]
        h.append(np.maximum(np.max(z, 0), 0))
    return _softmax((np.concatenate(h) @ net.weights + net.offset)[None])[0]


def test_prediction_is_the_convolution(net):
    texts = [EN.encode() * 20, FR.encode() * 9, b"x"]
    x, owner = windows(texts)
    want = np.array([np.mean([slow_forward(net, w) for w in x[owner == i]], 0) for i in range(3)])
    assert np.allclose(predict(net, net.tables(), texts), want, atol=1e-4)


def test_gradients():
    rng = np.random.default_rng(0)
    net = train([("ab", "a"), ("cd", "b")], epochs=0)
    x, y, weight = rng.integers(0, 256, (3, 20)), np.array([0, 1, 1]), np.array([1.0, 0.5, 2.0])
    params = [net.embedding, *net.filters, *net.biases, net.weights, net.offset]

    def loss():
        return sum(-w * np.log(slow_forward(net, a)[b]) for a, b, w in zip(x, y, weight, strict=True)) / 3

    for p, g in zip(params, _gradients(net, x, y, weight), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = loss()
        p[at] = old - 1e-5
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_windows_cover_whole_texts():
    x, owner = windows([b"a" * 600, b"", b"b" * 256])
    assert x.shape == (5, 256) and owner.tolist() == [0, 0, 0, 1, 2]
    assert bytes(x[:3].ravel()).rstrip(b"\0") == b"a" * 600


def test_identify(spark):
    rows = [(i, (EN if i % 2 else FR) * (1 + i % 5), "en" if i % 2 else "fr", "s", 0) for i in range(80)]
    odd = [(None, EN, None, None, 1), (900, None, "en", "s", 1), (901, "", "fr", "s", 1), (902, "12 34 !!", "en", "s", 1), (904, "½ ² 12 ① ٣", "en", "s", 1), (903, FR * 4000, None, "s", 1), (1, EN, "en", "s", 1)]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    got = identify(frame, frame.where("doc_id < 60")).collect()
    assert len(got) == len(rows + odd) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert by_id[900] == by_id[901] == by_id[902] == by_id[904] == "und" and by_id[903] == "fr" and by_id[None] == "en"
    assert {r.lang_pred for r in identify(frame, frame.limit(0)).collect()} == {"und"}
    assert identify(frame.limit(0), frame).count() == 0


def test_sample_is_bounded(spark):
    frame = spark.createDataFrame([(i, EN * (1 + i), "en" if i % 9 else "fr", "s", 0) for i in range(90)], SCHEMA)
    got = sample(frame, rows=7, chars=40)
    assert len(got) == 14 and max(len(text) for text, _ in got) <= 40
    assert {lang for _, lang in sample(frame, languages=1)} == {"en"}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in op8_language(spark, folder).collect() if r.held_out]
    assert len(held) > 200
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
