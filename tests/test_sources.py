import os
import tempfile

from nbsieve.sources import loaders as L


def test_sms_tsv(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "sms.tsv"), "w") as f:
        f.write("ham\tHello there\n\n  SPAM \t Win\tnow  \nbad line\nother\tx\n")
    rows = [tuple(r) for r in L.load_sms_tsv(spark, d).select("label", "text").collect()]
    assert rows == [("ham", "Hello there"), ("spam", "Win\tnow")]
    assert L.load_sms_tsv(spark, os.path.join(d, "missing")).count() == 0


def test_csv_directory_and_exclusive(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('Body,Text,Category\n"x","multi\nline",promotions\n"y","  ",spam\n"z","keep",1\n"w","drop",maybe\n')
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("foo,bar\n1,2\n")
    rows = sorted(tuple(r) for r in L.load_csv_directory(spark, d).select("label", "text").collect())
    # duplicate header candidates: the first in file order (Body) wins
    assert rows == [("spam", "x"), ("spam", "y"), ("spam", "z")]
    one = L.load_csv_directory(spark, d, limit_per_file=1).count()
    assert one == 1
    ex = sorted(tuple(r) for r in L.load_exclusive_csv(spark, os.path.join(d, "a.csv")).select("label", "text").collect())
    assert ex == [("spam", "x"), ("spam", "y")]  # no 1/0 fallback


def test_mail_tree(spark):
    d = tempfile.mkdtemp()
    for sub, name, body in [("spam", "1", "Subject: hi\n\nBuy cheap watches now, limited offer today!"),
                            ("easy_ham", "2", "Subject: re\n\nshort"), ("easy_ham", ".hidden", "x"),
                            ("spam", "cmds", "x"), ("other", "3", "Subject: a\n\nthis directory is ignored entirely")]:
        os.makedirs(os.path.join(d, sub), exist_ok=True)
        with open(os.path.join(d, sub, name), "w") as f:
            f.write(body)
    multi = ("Subject: m\r\nContent-Type: multipart/mixed;\r\n boundary=\"b.1\"\r\n\r\npreamble\r\n--b.1\r\n"
             "Content-Type: text/html\r\n\r\n<b>no</b>\r\n--b.1\r\nContent-Type: text/plain\r\n"
             "Content-Transfer-Encoding: base64\r\n\r\nVGhlIHBsYWluIHBhcnQg\r\nb2YgdGhlIG1lc3NhZ2Uh\r\n--b.1--\r\n")
    with open(os.path.join(d, "easy_ham", "5"), "w", newline="") as f:
        f.write(multi)
    os.makedirs(os.path.join(d, "spam", "nested", "spam"))
    with open(os.path.join(d, "spam", "nested", "spam", "9"), "w") as f:
        f.write("Subject: x\n\nonly direct children of a directory count here")
    rows = sorted(tuple(r) for r in L.load_mail_tree(spark, d).select("label", "text").collect())
    assert rows == [("ham", "The plain part of the message!"), ("spam", "Buy cheap watches now, limited offer today!")]
    cut = L.load_mail_tree(spark, d, truncate=9).where("label = 'spam'").first()["text"]
    assert cut == "Buy cheap" and L.load_mail_tree(spark, os.path.join(d, "none")).count() == 0


def test_csv_bad_bytes_limits_and_cuts(spark):
    d = tempfile.mkdtemp()
    for name, n in (("a.csv", 5), ("b.csv", 3)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"Message,Label\n" + b"".join(b'"fr\xffee %d",spam\n' % k for k in range(n)))
    rows = sorted(tuple(r) for r in L.load_csv_directory(spark, d).collect())
    assert rows == [(s, "spam", f"free {k}") for s, n in (("a.csv", 5), ("b.csv", 3)) for k in range(n)]
    two = sorted(tuple(r) for r in L.load_csv_directory(spark, d, limit_per_file=2, truncate=4).collect())
    assert two == [("a.csv", "spam", "free")] * 2 + [("b.csv", "spam", "free")] * 2
    ids = {r["doc_id"] for r in L.union_sources(spark, [L.load_csv_directory(spark, d)] * 2).collect()}
    again = {r["doc_id"] for r in L.union_sources(spark, [L.load_csv_directory(spark, d)] * 2).collect()}
    assert len(ids) == 16 and ids == again


def test_first_n_per_file(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "id % 3 AS f", "monotonically_increasing_id() AS r")
    got = L.first_n_per_file(df, "f", "r", 100, block_bits=4)
    want = {i for f in range(3) for i in [x for x in range(1000) if x % 3 == f][:100]}
    assert {r["id"] for r in got.collect()} == want


def test_table_normalisers(spark):
    cat = spark.createDataFrame([(" Promotions ", "a"), ("forum", "b"), ("other", "c"), ("spam", " ")],
                                "category string, text string")
    rows = sorted(tuple(r) for r in L.normalise_categories(cat, cat).select("label", "text").collect())
    assert rows == [("ham", "b"), ("ham", "b"), ("spam", "a"), ("spam", "a")]
    b = spark.createDataFrame([(1, "x"), (0, "y"), (2, "z"), (1, "")], "label int, text string")
    assert sorted(tuple(r) for r in L.normalise_binary(b).select("label", "text").collect()) == \
        [("ham", "y"), ("ham", "z"), ("spam", "x")]


def test_mail_nested_and_quoted_printable(spark):
    from email import message_from_string, policy

    from pyspark.sql import Observation

    d = tempfile.mkdtemp()
    os.makedirs(os.path.join(d, "spam"))
    plain = "Content-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: quoted-printable\n\n" \
        "Caf=E9 prices =3D low, 100% soft=\nbreak + more 1=2 =3d3D\n"
    mails = {
        "nested": "Subject: a\nContent-Type: multipart/mixed; boundary=out\n\npre\n--out\n"
                  "Content-Type: multipart/alternative;\n\tboundary=\"in ner\"\n\n--in ner\n" + plain +
                  "--in ner\nContent-Type: text/html\n\n<b>no</b>\n--in ner--\n--out\n"
                  "Content-Type: text/plain\nContent-Disposition: attachment\n\nthe attachment is not it\n--out--\n",
        "untyped": "Content-Type: multipart/mixed; boundary=\"=_x\"\n\n--=_x\n\n"
                   "a part without any header at all\n--=_xy\nnot a delimiter\n--=_x--\nepilogue, not a part\n",
        "epilogue": "Content-Type: multipart/mixed; boundary=o\n\n--o\nContent-Type: multipart/related; "
                    "boundary=i\n\n--i\nContent-Type: text/html\n\n<i>x</i>\n--i--\n--o\n"
                    "Content-Type: TEXT/PLAIN\n\nthe plain part follows the inner end\n--o--",
        "forward": "Content-Type: multipart/mixed; boundary=f\n\n--f\nContent-Type: message/rfc822\n\n"
                   "Subject: in\nContent-Type: multipart/mixed; boundary=g\n\n--g\n\n"
                   "the text of an attached message\n--g--\n--f\nContent-Type: text/plain\n\n"
                   "the text of the message itself\n--f--\n",
        "only_forward": "Content-Type: multipart/mixed; boundary=f\n\n--f\nContent-Type: message/rfc822\n\n"
                        "Subject: in\n\nthe only text is in an attached message\n--f--\n",
        "quoting": "Subject: b\n\nSomebody wrote of boundary=zz here:\n--zz\nand all of this is one text\n",
        "single_qp": "Content-Transfer-Encoding: quoted-printable\nContent-Type: text/plain; charset=utf-8\n\n"
                     "na=C3=AFve and 5 =3D 5 in a plain message =\nof one part",
        "cut_base64": "Content-Transfer-Encoding: base64\n\nVGhlIHBsYWluIHBhcnQg\nb2YgdGhlIG1lc3NhZ2Uh\n",
        "no_delimiter": "Content-Type: multipart/mixed; boundary=none\n\nno delimiter line occurs in this one\n",
    }

    def reference(raw):
        msg = message_from_string(raw, policy=policy.default)
        body = msg.get_body(preferencelist=("plain",))
        if body and len(body.get_content().strip()) > 10:
            return body.get_content().strip()
        for part in msg.walk():
            if not part.is_multipart() and (part.get_content_type() == "text/plain" or not msg.is_multipart()):
                return part.get_payload(decode=True).decode("utf-8", "ignore").strip()
        return None

    rows = spark.createDataFrame([(k, bytearray(v.encode())) for k, v in mails.items()], "k string, content binary")
    got = {r["k"]: r["body"] for r in L.with_mail_body(rows).collect()}
    assert got == {k: reference(v) for k, v in mails.items()}
    assert got["nested"] == "Café prices = low, 100% softbreak + more 1=2 =3D"

    mails |= {"html_only": "Content-Type: multipart/mixed; boundary=h\n\n--h\nContent-Type: text/html\n\n"
                           "<p>no plain part in this message</p>\n--h--\n", "short": "Subject: s\n\nshort"}
    for name, raw in mails.items():
        with open(os.path.join(d, "spam", name), "w") as f:
            f.write(raw)
    seen = Observation("mails")
    texts = L.load_mail_tree(spark, d, counts=seen).collect()
    assert len(texts) == len(mails) - 2
    assert seen.get == {"messages": len(mails), "no_body": 1, "short_body": 1}


def test_limited_corpus_files_follow_partitions(spark):
    from pyspark.sql import functions as F

    from nbsieve.queries import _limited_corpus

    df = spark.range(0, 240, 1, 12).select("id", F.lit("spam").alias("label"), F.concat(
        F.lit("line\nof "), F.format_string("%04d", "id")).alias("text"))
    path = _limited_corpus(spark, df)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]
    assert len(files) == 12
    kept = sorted(int(r["text"][-4:]) for r in L.load_csv_directory(spark, path, limit_per_file=7).collect())
    assert kept == [i for i in range(240) if i % 20 < 7]      # the first seven rows of every file
