from foliospark.sources.external import apply_tool, export_pages


def test_exports_are_isolated_and_counted(spark):
    def broken_on_b(row):  # a closure: workers cannot import this file
        if row["path"].endswith("b.json"):
            raise RuntimeError("no")
        return {"exported": row["page"].upper()}

    paths = spark.createDataFrame([("/o/a.json",), ("/o/b.json",), ("/o/a.json",)], "path string")
    exports, summary = export_pages(paths, broken_on_b)
    assert [(r.path, r.page, r.exported, r.ok) for r in exports.collect()] == [("/o/a.json", "a.html", "A.HTML", True), ("/o/b.json", "b.html", None, False)]
    assert tuple(summary.first()) == (1, 1, ["/o/b.json: no"])


def test_tool_on_no_rows(spark):
    rows = spark.createDataFrame([], "id long, path string")
    assert apply_tool(rows, lambda r: {}, ["id"], "text string, pages int").collect() == []
