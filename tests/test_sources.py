import json
import os
import tempfile

from veracity.sources import articles as A


def _write(path, text, enc):
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_csv_encodings(spark):
    d = tempfile.mkdtemp()
    body = '넘버링|내용|라벨\n1|"첫 줄\n둘째 ""줄"""|진짜\n2|NA|가짜\n'
    _write(os.path.join(d, "a.csv"), "\ufeff" + body, "utf-8")
    _write(os.path.join(d, "b.csv"), body.replace("1|", "3|").replace("2|", "4|"), "cp949")
    det = {os.path.basename(r["path"]): r["encoding"] for r in A.detect_encoding(spark, d).collect()}
    assert det == {"a.csv": "utf-8", "b.csv": "cp949"}
    df = A.read_articles_csv(spark, d, delimiter="|")
    rows = sorted((r["id"], r["text"], r["label"]) for r in df.collect())
    assert rows[0] == ("1", '첫 줄\n둘째 "줄"', "진짜")
    assert rows[1] == ("2", None, "가짜")  # NA → missing
    assert rows[2][0] == "3"


def test_csv_files_of_other_column_orders(spark):
    d = os.path.join(tempfile.mkdtemp(), "two words")
    os.mkdir(d)
    for name, text in {"a": "id|text|label\n1|aaa|real\n", "b": "\n\nid|label|text\n2|fake|bbb\n",
                       "c": 'id|"more\nx"|label\n3|u|real\n', "d": 'id|"more\ny"|label\n4|v|fake\n',
                       "e": "text|id|label\n가|5|가짜\n", "f": "id|text|label\n6|ccc|fake\n"}.items():
        _write(os.path.join(d, f"{name}.csv"), text, "cp949" if name == "e" else "utf-8")
    rows = {r["id"]: r.asDict() for r in A.read_articles_csv(spark, d, delimiter="|").collect()}
    got = {k: (r["text"], r["label"], r["more\nx"], r["more\ny"]) for k, r in rows.items()}
    assert got == {"1": ("aaa", "real", None, None), "2": ("bbb", "fake", None, None), "3": (None, "real", "u", None),
                   "4": (None, "fake", None, "v"), "5": ("가", "가짜", None, None), "6": ("ccc", "fake", None, None)}
    again = A.read_articles_csv(spark, [os.path.join(d, x) for x in ("a.csv", "b.csv")], "|", "utf-8", keep_blank=True)
    assert sorted(tuple(r) for r in again.select("id", "text", "label").collect()) == [
        ("1", "aaa", "real"), ("2", "bbb", "fake")]


def test_json_envelopes(spark):
    d = tempfile.mkdtemp()
    recs = [{"id": 1, "title": "t", "text": "본문", "label": "real", "emotion_spans": [{"phrase": "본"}]}]
    for name, doc in {"list": recs, "data": {"meta": 1, "data": recs}, "articles": {"articles": recs},
                      "single": recs[0]}.items():
        p = os.path.join(d, f"{name}.json")
        with open(p, "w", encoding="utf-8") as f:
            json.dump(doc, f, ensure_ascii=False)
        df = A.read_articles_json(spark, p)
        r = df.first()
        assert r["text"] == "본문" and json.loads(r["emotion_spans"]) == [{"phrase": "본"}], name


def test_ndjson_lines(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "a.json")
    with open(p, "w", encoding="utf-8") as f:
        f.write(json.dumps({"넘버링": 1, "내용": "가", "라벨": "진짜", "emotion_spans": ["가"]}, ensure_ascii=False) + "\n")
        f.write(json.dumps({"넘버링": 2, "내용": "나", "라벨": "가짜"}, ensure_ascii=False) + "\n")
    rows = sorted((r["id"], r["text"], r["emotion_spans"]) for r in A.read_articles_json(spark, p, lines=True).collect())
    assert rows == [("1", "가", '["가"]'), ("2", "나", None)]


def test_a_rewritten_table_is_seen_whole(spark, tmp_path):
    import pytest

    from veracity.sources import articles as A
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        A.read_current(spark, path)
    first = A.rewrite(spark.range(3).toDF("x"), path)
    A.rewrite(A.read_current(spark, path).where("x > 0"), path)
    assert sorted(r.x for r in A.read_current(spark, path).collect()) == [1, 2]
    # a version without its entry, as a failed rewrite leaves it, is not seen
    spark.range(9).toDF("x").write.parquet(f"{path}.versions/v00000003-lost")
    assert A.read_current(spark, path).count() == 2 and spark.read.parquet(first).count() == 3


def test_rows_keep_their_place_in_the_files(spark, tmp_path):
    """Row keys and ids in file order, over two header orders, quoted line breaks and both JSON forms."""
    from veracity.operators import clean as K
    for name, head in (("a", "text|label"), ("b", "label|text")):
        lines = [head]
        for i in range(50):
            row = {"text": f'"{name}{i}\nsecond line"', "label": "real"}
            lines.append("|".join(row[c] for c in head.split("|")))
        (tmp_path / f"{name}.csv").write_text("\n".join(lines), encoding="utf-8")
    back = A.read_articles_csv(spark, [str(tmp_path / f"{x}.csv") for x in "ba"], "|", place=True)
    got = K.with_generated_ids(K.with_row_key(back, A.PLACE), A.PLACE).orderBy("row_key").collect()
    assert [r["text"].split("\n")[0] for r in got] == [f"{x}{i}" for x in "ab" for i in range(50)]
    assert [r["id"] for r in got][:2] == ["news-0000001", "news-0000002"] and got[-1]["row_key"] == 99
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text(json.dumps({"n": 1, "items": [{"id": 5, "text": "u"}, {"id": 4, "text": "v"}]}))
    (tmp_path / "j" / "y.json").write_text("\ufeff" + json.dumps([{"id": 3, "text": "w"}]) + "\n", encoding="utf-8")
    (tmp_path / "j" / "z.json").write_text("\n")
    back = A.read_articles_json(spark, str(tmp_path / "j"), place=True)
    assert [r["id"] for r in back.orderBy(*A.PLACE).collect()] == ["5", "4", "3"]
    assert A.PLACE == back.columns[-3:] and A.read_articles_json(spark, str(tmp_path / "j")).columns == ["id", "text"]
    (tmp_path / "l.json").write_text("".join(json.dumps({"id": i, "text": "t"}) + "\n" for i in range(20)))
    back = A.read_articles_json(spark, str(tmp_path / "l.json"), lines=True, place=True)
    assert [r["id"] for r in back.orderBy(*A.PLACE).collect()] == [str(i) for i in range(20)]
