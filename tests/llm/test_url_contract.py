from lambi.llm import urls

#: The words of the contract, rule by rule.
CONTRACT = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
PAGES = [(1, "http://a.com/en/1", "com/en/"), (2, "http://b.example.com/en/71", "example.com/en/7"), (3, "http://a.net/de/8", "net/de/"), (4, "http://example.net/de/7", "net/de/"), (5, "http://b.example.net/de/81", "example.net/de/8"), (6, "http://b.org/es/", "org/es/")]


def test_words_of_the_rules(spark):
    df = spark.createDataFrame([p[:2] for p in PAGES], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(df, spark.createDataFrame(urls.LABELLED, "url string, label int")).collect()}
    assert got == {i: (rule, CONTRACT[rule]) for i, _, rule in PAGES}
