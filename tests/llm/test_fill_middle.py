import hashlib
import re
from pathlib import Path

import compare
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradientlab.llm import REGISTRY, SQL, fill_middle
from gradientlab.llm.common import prepare

FOLDER = "/root/testdata/sf0.01"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("abZ[`{@ \n<>PSM\0\x7f"), st.characters(exclude_categories=["Cs"])), max_size=60)


def brute(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    drawn = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(drawn[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, len(prefix), len(middle), output, text


def draws(docs):
    rows = [hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest() for d in docs]
    return np.array([[int(r[8 * k : 8 * k + 8], 16) for r in rows] for k in range(4)], dtype=np.int64).reshape(4, -1)


def ours(docs):
    found = fill_middle.transform_texts([t for _, t in docs], draws([d for d, _ in docs]))
    return [tuple(v.decode() if isinstance(v, bytes) else v for v in row) for row in found]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=12), st.integers(0, 1000))
def test_any_texts(texts, first):
    docs = list(enumerate(texts, first))
    assert ours(docs) == [brute(*d) for d in docs]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40).map(lambda b: b.decode("utf-8", "ignore")), st.data())
def test_rank_and_select_of_unit_ends(text, data):
    words, starts = fill_middle.joined([text.encode()])
    marks = fill_middle.Marks(fill_middle.unit_ends(words)[0])
    ends = np.cumsum([len(u.encode()) for u in UNIT.findall(text)], dtype=np.int64)
    assert marks.select(np.arange(len(ends))).tolist() == (ends - 1).tolist()
    at = data.draw(st.integers(0, len(text.encode())))
    assert marks.rank(np.array([at]))[0] == (ends <= at).sum()


@pytest.mark.parametrize("byte", range(128))
def test_every_ascii_byte(byte):
    text = f"a{chr(byte)}z" * 5
    words, _ = fill_middle.joined([text.encode()])
    marks = fill_middle.Marks(fill_middle.unit_ends(words)[0])
    assert marks.rank(np.array([len(text)]))[0] == len(UNIT.findall(text))


def test_blocks_of_words_meet(monkeypatch):
    texts = [(k, "Wörter über many blocks, 漢字 and 🙂 " * 40 + "x" * k) for k in range(30)]
    wanted = [brute(*d) for d in texts]
    for span, run in ((1, 1), (3, 500), (64, 10_000)):
        monkeypatch.setattr(fill_middle, "SPAN", span)
        monkeypatch.setattr(fill_middle, "RUN", run)
        assert ours(texts) == wanted


def test_sentinels_never_form_across_a_cut():
    docs = [(k, t) for t in ("a<P b<S c<M d>", "<" * 9 + "S>"[:1], "<<S<M<P", "P>S>M>") for k in range(200)]
    assert ours(docs) == [brute(*d) for d in docs]
    assert {r[1] for r in ours(docs)} == {"plain", "psm", "spm"}


def test_restore_refuses_other_outputs():
    for output, form in ((b"abc", "psm"), (b"<P>a<S>b", "psm"), (b"<S>a<M>b", "spm")):
        with pytest.raises(ValueError):
            fill_middle.restore(output, form)


def test_odd_rows(spark):
    prepare(spark)
    docs = [(1, None), (2, ""), (3, "<P>"), (None, "no id here"), (4, "same"), (4, "same"), (5, "Very long " * 300_000), (6, "a"), (7, "\0\0")]
    df = spark.createDataFrame([(*d, "keep", 1) for d in docs], "doc_id bigint, text string, form string, extra int")
    found = fill_middle.fill_in_middle(df)
    assert found.columns == ["doc_id", "text", "extra", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    key = lambda r: (str(r[0]), str(r[1:]))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found.collect()), key=key)
    assert got == sorted(((d, *brute(d, t)) for d, t in docs), key=key)
    assert fill_middle.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
def test_query_op12(spark):
    assert not compare.difference(REGISTRY["op12_fill_middle"](spark, FOLDER), compare.duck(FOLDER), SQL["op12_fill_middle"])
