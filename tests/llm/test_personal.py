"""Hostile texts, and spans that the base patterns miss."""

import pytest

from simplexa.llm import personal

LONG, MIXED = 1_000_000, 60_000


@pytest.mark.parametrize("units,size", [
    (["1", ".", "@", "+", "(", "[at]", "a", "-", " ", "1 "], LONG), (["1.", "a.", "a@", "+1", "1-", "(1", "[dot]a", "é"], MIXED)])
def test_long_runs(spark, units, size):
    """Long runs of any class neither crash nor hide what stands beside them."""
    runs = [unit * (size // len(unit)) for unit in units]
    rows = [(i, 1, f"mail x@y.org . {run}") for i, run in enumerate(runs)] + [
        (i, 2, f"{run} . mail x@y.org") for i, run in enumerate(runs)]
    df = spark.createDataFrame(rows, "doc_id long, side int, text string").repartition(8)
    assert personal.personal_data(df, personal.Model()).where("n_email >= 1").count() == len(rows)
    left = personal.redacted(df, personal.Model()).collect()
    assert all(r.text.startswith("mail [EMAIL]") if r.side == 1 else r.text.endswith("mail [EMAIL]") for r in left)


def test_many_matches(spark):
    n = 5_000
    df = spark.createDataFrame([(1, "1.2.3.4 " * n)], "doc_id long, text string")
    row = personal.personal_data(df, personal.Model()).first()
    assert row.n_ip == n
    assert row.spans == ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(n))


def luhn_digit(digits):
    d = [int(c) for c in digits[::-1]]
    total = sum(x if i % 2 else 2 * x - 9 * (x > 4) for i, x in enumerate(d))
    return str(-total % 10)


@pytest.fixture(scope="module")
def texts():
    out = []
    for i in range(400):
        card = f"4{i:03d}{i * 7919 % 10**8:08d}{i * 31 % 1000:03d}"
        out += [
            f"please write to name{i}.x@mail{i % 9}.example.com about the thing",
            f"the card {card}{luhn_digit(card)} was used",
            f"call +1 ({200 + i}) 555-{1000 + i} now",
            f"order {4000000000000000 + i * 10 + (int(luhn_digit(str(400000000000000 + i))) + 1) % 10} of last year",
            f'token = "ab{i}cd{1000000 + i * 37}ef"', f"from {i} to {i + 1} of them at noon",
            f"version {i % 9}.2.3 of 20{i % 30:02d}-{1 + i % 12:02d}-{1 + i % 28:02d}",
        ]
    return out


def test_disguised_spans_are_found(spark, texts):
    planted = [
        ("write to jane.doe (at) host (dot) org soon", "jane.doe (at) host (dot) org"),
        ("write to jane.doe[at]host[dot]org soon", "jane.doe[at]host[dot]org"),
        ("the card 4111.1111.1111.1111 was used", "4111.1111.1111.1111"),
        ("call (201) 555-0147 now", "(201) 555-0147"),
    ]
    clean = ["order 4111111111111112 of last year", "from 12 to 13 of them", "version 1.2.3 of 2020-01-02", "a (at) b"]
    rows = [*texts, *(t for t, _ in planted), *clean, None, ""]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    model = personal.fitted(df.where(f"doc_id < {len(texts)}"))
    got = {r.doc_id: r for r in personal.personal_data(df, model).collect()}
    left = {r.doc_id: r.text for r in personal.redacted(df, model).collect()}
    for i, (text, span) in enumerate(planted, len(texts)):
        at = text.index(span)
        assert f":{at}:{at + len(span)}" in got[i].spans, text
        assert span not in left[i]
    first = len(texts) + len(planted)
    assert [left[i] for i in range(first, first + 3)] == clean[:3]
    # Of the ordinary texts, numbers that are no card and parts of tokens stay.
    wrong = [i for i, t in enumerate(texts) if t.startswith(("order", "token", "from", "version")) and got[i].spans]
    assert len(wrong) <= len(texts) // 200


def test_one_class_adds_nothing(spark):
    df = spark.createDataFrame([(1, "a@b.org")], "doc_id long, text string")
    assert personal.personal_data(df).first().spans == "email:0:7"
