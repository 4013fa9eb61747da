import pytest

from spanwright.llm.secrets import secret_spans

SECRET, IDENT = "0123456789abcdef" * 2, "client_id=abcdef"


def linked(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r.doc_id: r.n_linked for r in secret_spans(rows).collect()}


def test_both_bounds_of_the_scope_at_all_offsets(spark):
    texts, want = [], []
    for gap in (199, 200, 201):
        for offset in range(401):
            for pair in ((SECRET, IDENT), (IDENT, SECRET)):
                texts.append(" " * offset + pair[0] + " " * gap + pair[1])
                want.append(int(gap <= 200))
    assert linked(spark, texts) == dict(enumerate(want))


@pytest.mark.parametrize(("endpoints", "n"), [
    (["postgres://app:pw@db.example/x", "amqp://mq.example:5672", "db.example.com:5432", "10.0.0.7:6379", "localhost:8080", "git+https://a.example/x", "mongodb+srv://c.example"], 2),
    (["at 12:30", "verse 3:16", "note:1234", "3.14:15", "a.b@c.example"], 1),
])
def test_endpoints_of_other_schemes_and_hosts(spark, endpoints, n):
    texts = [f"{SECRET} {IDENT} {e} end" for e in endpoints]
    assert linked(spark, texts) == dict.fromkeys(range(len(texts)), n)
