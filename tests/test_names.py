import pytest
from pyspark.sql import functions as F

from pricelane.functions import names

# name, profile, volume, unit
QUANTITIES = [
    ("Fineline Sunny Gold 550 ML. Gold", "makro", 550.0, "ML"),
    ("PAO Super White 1.8 kg x 1+1", "makro", 1.8, "KG"),
    ("PAO Super White 1.8 kg x 1+1", "bigc", None, "KG"),
    ("PAO Super White 1.8 kg x 1+1", "lotus", None, "KG"),
    ("PAO Super White 1.8 kg x 1+1", "tops_base", 8.0, "KG"),
    ("Softener 1,300 ml", "makro", 300.0, "ML"),
    ("Softener 1,300 ml", "7e", 1300.0, "ml"),
    ("Powder 500 grams", "makro", 500.0, "G"),
    ("Dish wash 3.2ltr", "tops", 3.2, "L"),
    ("POWDER DETERGENT1800G.P2", "lotus", 1800.0, "G"),
    ("Pack 2 Lemon 500ml", "makro", 2.0, "L"),
    ("Happy Sweet Pink 2.3/2.5 kg", "makro", 2.5, "KG"),
    ("น้ำยา 500 มล. (แพ็ก 3 ชิ้น)", "7e", 500.0, "มล."),
    ("ผงซักฟอก 2400 กรัม", "7e", 2400.0, "กรัม"),
    ("ผงซักฟอก 2400 กรัม", "lotus", 2400.0, "กรัม"),
    ("Cooking oil 3.5 liters - 123456", "go", 3.5, "liters"),
    ("Lemonade 12 LITERS", "go", 12.0, "liters"),
    ("500 ml with a no-break space", "makro", 500.0, "ML"),
    ("no quantity", "makro", None, None),
    ("1.2.3 kg", "makro", None, "KG"),
    ("", "makro", None, None),
    (None, "makro", None, None),
]

# name, profile, pack
PACKS = [
    ("soap x 1+1", "makro", "X 1+1"),
    ("soap x 1+1", "tops", "X 1+1"),
    ("soap x 1+1", "bigc", "X 1"),
    ("soap Pack 2+1", "makro", "PACK 2+1"),
    ("soap PACK 1+1", "lotus", "PACK 1+1"),
    ("soap x 3", "makro", "X 3"),
    ("soap Pack of 2", "makro", "PACK"),
    ("soap TWIN PACK", "lotus", "PACK"),
    ("soap TWINPACK", "lotus", "TWINPACK"),
    ("soap 480 ml pack 2 free 1", "bigc", "PACK 2 FREE 1"),
    ("soap 550ml-x-21pcs", "lotus", None),
    ("soap P1+1", "lotus", "P1+1"),
    ("soap (1+1)", "bigc", "(1+1)"),
    ("soap Buy 2 free 1", "makro", "2 FREE 1"),
    ("ไลปอนเอฟ 500 มล. (แพ็ก 3 ชิ้น)", "7e", "แพ็ก 3 ชิ้น"),
    ("ไลปอนเอฟ 500 มล. (แพ็ก 3 ชิ้น)", "makro", None),
    ("HYGIENE 480 ML X 2+1 BAGS", "makro", "X 2+1"),
    ("HYGIENE 480 ML X 2+1 BAGS", "lotus", "X 2"),
    ("max 3 per order", "makro", None),
    ("กx 3", "makro", None),
]


def answers(spark, rows, build):
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, name string")
    results = {}
    for profile in {r[1] for r in rows}:
        for got in frame.select("i", build(F.col("name"), profile).alias("x")).collect():
            results[got["i"], profile] = got["x"]
    return [results[i, r[1]] for i, r in enumerate(rows)]


def test_volume(spark):
    assert answers(spark, QUANTITIES, names.volume) == [r[2] for r in QUANTITIES]


def test_unit(spark):
    assert answers(spark, QUANTITIES, names.unit) == [r[3] for r in QUANTITIES]


def test_pack(spark):
    assert answers(spark, PACKS, names.pack) == [r[2] for r in PACKS]


@pytest.mark.parametrize(
    "name, brand",
    [
        ("ไลปอนเอฟ น้ำยาล้างจาน", "ไลปอนเอฟ"),
        ("เปาวินวอช น้ำยาซักผ้า", "เปา"),
        ("โปร บลูพลัส", "โปร"),
        ("ของ เปา", "ของ"),
        ("", ""),
        (None, None),
    ],
)
def test_brand_dictionary(spark, name, brand):
    frame = spark.createDataFrame([(name,)], "name string")
    assert frame.select(names.brand_dictionary(F.col("name"))).first()[0] == brand


def test_go_product_id(spark):
    frame = spark.createDataFrame(
        [("oil - 123456",), ("oil -77 ",), ("oil - 12 x",), ("oil",)], "name string"
    )
    got = [r[0] for r in frame.select(names.go_product_id(F.col("name"))).collect()]
    assert got == ["123456", "77", None, None]
