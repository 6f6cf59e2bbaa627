"""The checked queries' inputs use all cores, however small their table is."""

from checks import inputs
from pricelane.sources.html_tree import HtmlTree


def test_small_tables_are_spread_before_texts_are_made(spark, folder):
    cores = spark.sparkContext.defaultParallelism
    plain = inputs.price_rows(spark, folder)
    spread = inputs.price_rows(spark, folder, spread=True)
    assert plain.rdd.getNumPartitions() < cores == spread.rdd.getNumPartitions()
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    plan = inputs.details_makro(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    exchanges, made = plan.index("RepartitionByExpression"), plan.index("pdp_product_title")
    assert made < exchanges and "Brand" not in plan[exchanges:] and "concat" not in plan[exchanges:]


def test_hidden_parts_are_told_by_attributes_of_any_order():
    page = "<div id=a>1</div><div style='DISPLAY: none' id=b>2</div><p hidden>3</p><p style='color:red'>4</p><p style>5</p>"
    tree = HtmlTree(page)
    assert tree.lines(tree.root) == ["1", "4", "5"] and tree.texts(tree.root) == ["1", "2", "3", "4", "5"]
