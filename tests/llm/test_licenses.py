from tickloom.llm import licenses

DOCS = "doc_id long, text string"


def test_whole_texts_and_lines(spark, odd_docs, no_docs):
    mit = "The MIT Licence (MIT)\n\nCopyright (c) 2020 Somebody\nAll rights reserved.\n\n" + licenses._MIT.upper().replace(" ", "  ").replace(",", "")
    rows = [(1, mit), (2, "Text.\n  * RELEASED under the mit licence!\nMore.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0"), (3, licenses._MIT[:-20]), (None, "Licensed under CC BY 4.0."), (None, None), (4, "")]
    got = {(r.doc_id, r.digest): r for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    by = {k[0]: v for k, v in got.items() if k[0]}
    assert len(got) == 6 and by[1].license == "MIT" and by[3].license is None
    assert (by[2].license, by[2].line_licenses, by[2].n_license_lines) == (None, "CC-BY-NC-4.0,MIT", 3)
    assert by[4].license is None and by[4].n_license_lines == 0
    assert sorted(str(r.license) for k, r in got.items() if k[0] is None) == ["CC-BY-4.0", "None"]
    assert licenses.scan(odd_docs).count() == odd_docs.count() and licenses.scan(no_docs).count() == 0


def test_copyright_lines_alone_match_nothing(spark):
    known = spark.createDataFrame([("X", "Copyright 2020"), ("Y", None), ("A", "same text"), ("B", "Same, text.")], "license string, text string")
    docs = spark.createDataFrame([(1, "(c) 1999 me"), (2, "SAME TEXT")], DOCS)
    assert {r.doc_id: r.license for r in licenses.scan(docs, known).collect()} == {1: None, 2: "A OR B"}
