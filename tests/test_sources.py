import datetime

import pytest

from tidemark.sources import files


def written(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_ratings_ignore_further_fields(spark, tmp_path):
    path = written(tmp_path, "r", "1::10::4::1400000003::A: B (1999)\n2::11::0::1400000004::C\n")
    rows = files.read_ratings(spark, path).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [(1, 10, 4.0, 1400000003), (2, 11, 0.0, 1400000004)]


def test_items_keep_single_colons(spark, tmp_path):
    path = written(tmp_path, "i", "1::Alien: The Return\n")
    assert files.read_items(spark, path).first().title == "Alien: The Return"


def test_catalog(spark, tmp_path):
    path = written(tmp_path, "c", "1::shirt::North Wind\n")
    assert tuple(files.read_catalog(spark, path).first()) == (1, "shirt", "North Wind")


def test_triples_raise_on_other_shapes(spark, tmp_path):
    good = written(tmp_path, "good", "1,2,5.0\n1,3,1.0\n")
    assert files.read_triples(spark, good).count() == 2
    bad = written(tmp_path, "bad", "1,2,5.0\n1,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_triples(spark, bad).collect()


def test_feature_csv(spark, tmp_path):
    path = written(tmp_path, "f.csv", "name,q1,q2\nrow1,0,106.8\nrow2,3.5,1\n")
    rows = files.read_feature_csv(spark, path, ["q1", "q2"]).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [("row1", 0.0, 106.8), ("row2", 3.5, 1.0)]


def test_captions_with_quotes_and_separators(spark, tmp_path):
    text = 'username;caption;tag;tagId;link\n"ann";"one; two ""three"" 😀";"sea";1;"l"\n"{""n"":""bo""}";"";"sky";2;"m"\n'
    rows = files.read_captions(spark, written(tmp_path, "c", text)).orderBy("tag_id").collect()
    assert rows[0].caption == 'one; two "three" 😀'
    assert rows[1].username == '{"n":"bo"}' and not rows[1].caption


def test_vectors_with_trailing_space(spark, tmp_path):
    rows = files.read_vectors(spark, written(tmp_path, "v", "1 2.5 3 \n4 5 6\n")).collect()
    assert sorted(list(r.features) for r in rows) == [[1.0, 2.5, 3.0], [4.0, 5.0, 6.0]]


def test_vectors_raise_on_text(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_vectors(spark, written(tmp_path, "v", "1 x 3\n")).collect()


def test_labelled_vectors(spark, tmp_path):
    row = files.read_labelled_vectors(spark, written(tmp_path, "l", "3,0.25 0.75 \n")).first()
    assert row.label == 3.0 and list(row.features) == [0.25, 0.75]


def test_whole_files_and_listing(spark, tmp_path):
    written(tmp_path, "docs/good/a.txt", "line 1\nline 2")
    written(tmp_path, "docs/bad/deep/b.txt", "x")
    written(tmp_path, "docs/bad/empty.txt", "")
    rows = {r.id: r for r in files.read_whole_files(spark, str(tmp_path / "docs")).collect()}
    assert rows["a.txt"].label == "good" and rows["a.txt"].text == "line 1\nline 2"
    assert rows["b.txt"].label == "deep" and rows["empty.txt"].text == "" and len(rows) == 3
    listed = {(r.parent, r.name): r.length for r in files.list_files(spark, str(tmp_path / "docs")).collect()}
    assert listed == {("good", "a.txt"): 13, ("deep", "b.txt"): 1, ("bad", "empty.txt"): 0}


def test_personal_ratings(spark, tmp_path):
    path = written(tmp_path, "p", "0::1::4::14::A\n0::2::0::14::B\n")
    assert [r.item_id for r in files.load_personal_ratings(spark, path).collect()] == [1]
    none = written(tmp_path, "none", "0::2::0::14::B\n")
    with pytest.raises(ValueError, match="no ratings"):
        files.load_personal_ratings(spark, none)


def test_stop_words(spark, tmp_path):
    words = files.read_stop_words(spark, written(tmp_path, "s", "a\ncan't\tours\n a\n"))
    assert sorted(r.word for r in words.collect()) == ["a", "can't", "ours"]


TYPED = '''@relation harbour

@attribute ship string
@attribute built date yyyy-MM-dd
@attribute flag {north,south,east}
@attribute crew integer
@attribute cargo relational
@attribute cargo.good {grain,ore}
@attribute cargo.tons numeric
@end cargo
@attribute draught real

@data
% arrivals of one morning
'Old Tern',1987-03-02,north,14,'grain,120.5\\nore,80',6.25

'% Gull, the third',2011-08-30,east,9,'ore,33.3',4.5
@crane,1999-12-31,south,3,'grain,1',1.0
'''


def test_header_typed_table(spark, tmp_path):
    rows = files.read_header_typed(spark, written(tmp_path, "t.arff", TYPED)).orderBy("draught").collect()
    assert [r.ship for r in rows] == ["@crane", "% Gull, the third", "Old Tern"]
    assert rows[2].built == datetime.date(1987, 3, 2) and [r.crew for r in rows] == [3, 9, 14]
    assert [tuple(p) for p in rows[2].cargo] == [("grain", 120.5), ("ore", 80.0)]
    assert [tuple(p) for p in rows[1].cargo] == [("ore", 33.3)]


def test_header_typed_table_checks_nominals(spark, tmp_path):
    with pytest.raises(Exception, match="not declared"):
        files.read_header_typed(spark, written(tmp_path, "t.arff", TYPED.replace(",east,", ",west,"))).collect()


def test_separate_header_takes_every_data_line(spark, tmp_path):
    head = "@attribute who string\n@attribute n numeric\n@data\n"
    body = "@alice,1\n'%50 off',2\n@data,3\n"
    found = files.read_header_typed(spark, written(tmp_path, "b.csv", body), written(tmp_path, "h.arff", head)).collect()
    assert {(r.who, r.n) for r in found} == {("@alice", 1.0), ("%50 off", 2.0), ("@data", 3.0)}


def test_materialize_once(spark, tmp_path):
    runs, path = [], str(tmp_path / "out")

    def stage():
        runs.append(1)
        return spark.range(3)

    assert files.materialize_once(spark, path, stage).count() == 3
    assert files.materialize_once(spark, path, stage).count() == 3
    assert runs == [1]


def test_write_delimited_replaces(spark, tmp_path):
    path = str(tmp_path / "d")
    for value in ("a", "b"):
        files.write_delimited(spark.createDataFrame([(1, value)], "id int, v string"), path, "::")
    assert [r.value for r in spark.read.text(path).collect()] == ["1::b"]
