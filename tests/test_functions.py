import pytest
from pyspark.sql import functions as F

from tessera.functions import messages, text, udfs
from tessera.functions.cleaning import clean
from tessera.sources.messages import decode


def one(spark, expression, ddl, *values):
    return spark.createDataFrame([values], ddl).select(expression).first()[0]


NAMES = [
    ("Mr. John Doe", "John Doe"),
    ("JANE SMITH", "Jane Smith"),
    (None, None),
    ("Sr(a). Juan", "A Juan"),
    ("Sig.ra Maria", "Ra Maria"),
    ("Dott.", ""),
    ("John Mr. Smith", "John  Smith"),
    ("JEAN-PAUL O'NEIL", "Jean-Paul O'Neil"),
    (" \tÁNGEL 2nd\n", "Ángel 2Nd"),
]


@pytest.mark.parametrize("given, wanted", NAMES)
def test_clean_name(spark, given, wanted):
    assert one(spark, text.clean_name(F.col("c")), "c string", given) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("+34 678-123-456", "+34678123456"),
        ("1234567890", "1234567890"),
        (None, None),
        ("001-696-430-9514x651", "0016964309514651"),
    ],
)
def test_clean_phone(spark, given, wanted):
    assert one(spark, text.clean_phone(F.col("c")), "c string", given) == wanted


def test_clean_record(spark):
    record = spark.createDataFrame(
        [("Dr. ALICE SMITH", "O'Neil, X", " (111) 222-3333 ", "123 Fake St, Apt 4", ["female"])],
        "name string, last_name string, telfnumber string, address string, sex array<string>",
    )
    assert clean(record).first().asDict() == {
        "name": "Alice Smith",
        "last_name": "O'Neil, X",
        "telfnumber": "1112223333",
        "address": "123 Fake St Apt 4",
        "sex": "female",
    }


@pytest.mark.parametrize("given, wanted", [([], None), (None, None), (["M", "F"], "M")])
def test_clean_sex_list(spark, given, wanted):
    df = spark.createDataFrame([(given,)], "sex array<string>")
    assert clean(df).first()["sex"] == wanted


@pytest.mark.parametrize(
    "a, b, wanted",
    [
        ("1 Calle MAYOR ", "1callemayor", True),
        ("1\tCalle", "1Calle", False),
        ("", "", False),
        (None, "x", False),
    ],
)
def test_address_match(spark, a, b, wanted):
    found = text.address_match(F.col("a"), F.col("b"))
    assert one(spark, found, "a string, b string", a, b) is wanted


@pytest.mark.parametrize(
    "name, last, full, wanted",
    [
        (" ana ", "LN1", "Ana Ln11", True),
        ("Jose", "X", "José X", False),
        ("", "X", "a X", False),
        ("Ana", " ", "ana", True),
        ("Ana", "X", None, False),
    ],
)
def test_names_in_fullname(spark, name, last, full, wanted):
    found = text.names_in_fullname(F.col("n"), F.col("l"), F.col("f"))
    assert one(spark, found, "n string, l string, f string", name, last, full) is wanted


@pytest.mark.parametrize(
    "value, wanted",
    [
        ("10.0.0.7", True), ("255.255.255.255", True), ("256.1.1.1", False),
        ("1.2.3", False), ("01.2.3.4", False), (None, False), ("1.2.3.4\n", False),
    ],
)
def test_is_ipv4(spark, value, wanted):
    assert one(spark, text.is_ipv4(F.col("c")), "c string", value) is wanted


def test_day_second_and_default(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-05-06 07:08:09.5' AS ts, '' AS c")
    row = df.select(
        text.day_of(F.col("ts")), text.second_of(F.col("ts")),
        text.or_default(F.col("c"), F.lit("x")),
    ).first()
    assert tuple(row) == ("2024-05-06", "2024-05-06 07:08:09", "x")


def test_prefix_filter(spark):
    df = spark.createDataFrame([("Engineer",), ("engineer",), (None,)], "job string")
    assert df.where(text.prefix_filter(F.col("job"), "Eng")).count() == 1
    assert df.where(text.prefix_filter(F.col("job"), "ALL")).count() == 3


def test_sql_functions_agree(spark):
    names = udfs.register(spark)
    assert "clean_name" in names
    df = spark.createDataFrame(NAMES, "c string, wanted string")
    df.createOrReplaceTempView("names_to_clean")
    rows = spark.sql("SELECT clean_name(c) AS got, wanted FROM names_to_clean").collect()
    assert all(r.got == r.wanted for r in rows)
    row = spark.sql(
        "SELECT clean_phone('+1 (2)x3'), clean_address('a, b'), first_sex(array('F')),"
        " address_match('1 A', '1a'), names_in_fullname('Ana', ' ', 'ana x')"
    ).first()
    assert tuple(row) == ("+123", "a b", "F", True, True)


@pytest.mark.parametrize(
    "message, wanted",  # the type, and the reason why it cannot be stored
    [
        ('{"passport":1,"name":2,"IBAN":3}', ("personal", None)),
        ('{"fullname":1,"city":2,"company":3}', ("location", None)),
        ('{"job":1}', ("professional", "no key")),
        ('{"IBAN":1,"passport":null}', ("bank", "no key")),
        ('{"address":1,"IPv4":2}', ("net", None)),
        ('{"PASSPORT":1,"NAME":2}', ("personal", "no key")),
        ('{"x":1}', ("unknown", None)),
        ("{}", ("unknown", None)),
        ('{"x":1', (None, "not a JSON object")),
        ('{"x":1,"x":2}', (None, "not a JSON object")),
        ("[1]", (None, "not a JSON object")),
        ("null", (None, "not a JSON object")),
        (None, (None, "not a JSON object")),
    ],
)
def test_routing(spark, message, wanted):
    row = decode(spark.createDataFrame([(message,)], "value string")).first()
    assert (row.fragment_type, row.reason) == wanted


def test_decoded_fields(spark):
    value = '{"sex":["F"],"passport":"P","name":null,"company address":"x, y","salary":5}'
    row = decode(spark.createDataFrame([(value,)], "value string")).first()
    assert (row.sex, row.passport, row.name, row.company_address, row.salary) == (
        "F", "P", None, "x, y", "5",
    )
    assert sorted(row.present) == ["company address", "name", "passport", "salary", "sex"]


def test_fingerprint(spark):
    df = spark.createDataFrame(
        [('{"b":1,"a":{"d":1,"c":2}}',), (' {"a":{"c":2, "d":1}, "b":1}',), ('{"b":1}',)],
        "value string",
    )
    prints = df.select(messages.fingerprint(F.try_parse_json("value"))).collect()
    assert prints[0] == prints[1] != prints[2]


def test_json_encoding_and_size(spark):
    df = spark.createDataFrame([("José", None)], "a string, b string")
    text_ = df.select(messages.encoded("a", "b").alias("j"))
    row = text_.select("j", messages.byte_size(F.col("j")).alias("n")).first()
    assert row.j == '{"a":"José"}' and row.n == 13
