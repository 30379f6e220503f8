"""Measures and shared lines against plain counting."""

import re
from collections import Counter, defaultdict

import pytest

from tidelake.llm import quality
from tidelake.llm.queries import op2_quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = W.findall(text)
    lines = [x for x in text.split("\n") if W.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    held = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(held)


def normal(line):
    low = "".join(c.lower() if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in line)
    return " ".join(W.findall(low))


def plain(rows, least, share, class_of=None):
    """doc rows (doc_id, text, host) to (base, failed, kept, clean text); texts of one class count once."""
    class_of = class_of or {}
    holds, totals = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        totals[host].add(class_of.get(text, text or ""))
        for line in (text or "").split("\n"):
            if normal(line):
                holds[host, normal(line)].add(class_of.get(text, text))
    shared = {k for k, v in holds.items() if len(v) > least and len(v) > share * len(totals[k[0]])}
    out = []
    for doc_id, text, host in rows:
        base = plain_measures(text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        lines = (text or "").split("\n")
        cut = [x for x in lines if (host, normal(x)) in shared]
        removed = sum(len(W.findall(x)) for x in cut)
        clean = "\n".join(x for x in lines if (host, normal(x)) not in shared) if cut else text
        out.append((doc_id, *base, failed, removed, not failed and removed <= base[0] / 2, clean))
    return out


@pytest.fixture(scope="module")
def rows():
    body = [" ".join(f"d{i}w{k}" for k in range(60)) for i in range(30)]
    out = [(i, f"{body[i]}\nSee page {i}  of the  site", "a") for i in range(15)]
    out += [(100 + i, f"{body[0]}\nsee PAGE {i} of the site", "b") for i in range(3)]
    out += [(200, "short", "a"), (201, None, "a"), (202, "", None), (203, "x y z " * 40, None), (204, "\n \n" + body[20] + "\n" + body[20], "a")]
    out += [(300 + i, f"{' '.join(f'h{i}v{k}' for k in range(20))}\n{' '.join('boiler%s' % k for k in range(45))}", "c") for i in range(14)]
    out += [(400, body[3], "a"), (400, body[3], "a"), (None, body[4], "a"), (401, "é ß\x1c* " * 30 + "tail", "a"), (402, "k" * 100_000, "a")]
    return out


@pytest.mark.parametrize("sent", [2_000_000, 0])
def test_judge(spark, monkeypatch, rows, sent):
    monkeypatch.setattr(quality, "MOST_SENT", sent)  # by a sent set, and by joins
    frame = spark.createDataFrame([(i, t, h, 1, "x") for i, t, h in rows], "doc_id bigint, text string, source string, kept int, line_key string").repartition(3)
    want = plain(rows, 10, 0.02)
    assert any(not w[8] and not w[6] for w in want)  # depleted documents are among them
    got = [tuple(r) for r in quality.judge(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    good = quality.keep_good(frame)
    assert good.schema == frame.schema
    assert sorted(str((r.doc_id, r.text)) for r in good.collect()) == sorted(str((w[0], w[-1])) for w in want if w[8])
    assert quality.judge(frame.limit(0)).count() == quality.keep_good(frame.limit(0)).count() == 0


def test_many_words():
    words = [b"w%d" % (k % 7) for k in range(50)]
    assert quality.repeated_words(words) == plain_measures(b" ".join(words).decode())[4]
    big = [b"%d" % k for k in range(2_000_002)] + [b"0", b"1", b"2"]
    assert quality.repeated_words(big) == 6


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source").collect()]
    want = {w[0]: w[1:] for w in plain(docs, 10, 0.02)}
    for r in op2_quality(spark, small).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.removed_words, r.kept) == want[r.doc_id][:8]
