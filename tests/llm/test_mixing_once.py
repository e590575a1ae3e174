"""Mixing without texts judges every document once: the result is read from what the fit stored."""

from tidemark.llm import mixing


def test_documents_are_judged_once_and_rated_alike(spark):
    docs = spark.range(60).selectExpr("id doc_id", "if(id % 7 = 0, null, concat(if(id % 3 = 0, 'click here now ', 'the sea was calm '), 'w', id)) text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 3 = 0, 0, 1) quality")
    once = mixing.report(docs, labels)
    assert "MapInArrow" not in once._jdf.queryExecution().executedPlan().toString()
    twice = mixing.mixed(docs, labels).select("doc_id", "tokens", "rate", "copies")
    # The two fits add doubles in orders of their own and may end a step apart.
    shown = lambda df: {r.doc_id: r for r in df.collect()}
    one, two = shown(once), shown(twice)
    assert one.keys() == two.keys() and all(r.tokens == two[k].tokens and abs(r.rate - two[k].rate) < 1e-3 for k, r in one.items())
