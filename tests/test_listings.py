from millrace.plans.listings import listings_parse
from millrace.plans.pipelines import load_listings


def test_listing_names(spark):
    names = [
        "Flat · ★4.9 · 1 bedroom · 2 beds · 1 bath",
        "House · 3 bedrooms · 4 beds · 2 baths",
        "Room · ★New · Studio",
        "Tent",
        None,
    ]
    df = spark.createDataFrame([(i, n, "g", "l") for i, n in enumerate(names)], "id int, name string, neighbourhood_group string, license string")
    out = listings_parse(df)
    assert out.columns == ["id", "description", "reviews", "bedrooms", "beds", "baths"]
    assert [tuple(r)[1:] for r in out.orderBy("id").collect()] == [
        ("Flat", "4.9", "1 bedroom", "2 beds", "1 bath"),
        ("House", None, "3 bedrooms", "4 beds", "2 baths"),
        ("Room", "New", "Studio", None, None),
        ("Tent", None, None, None, None),
        (None, None, None, None, None),
    ]


def test_listings_folder(spark, namespace, tmp_path):
    (tmp_path / "listings.csv").write_text("id,name,neighbourhood_group,license\n1,Flat · ★4.9 · 1 bedroom,g,l\n", encoding="utf-8")
    (tmp_path / "hosts.csv").write_text("id,name\n1,Ann\n")
    for _ in range(2):
        tables = load_listings(spark, str(tmp_path), namespace)
    assert tuple(tables["listings"].head()) == (1, "Flat", "4.9", "1 bedroom", None, None)
    assert tuple(tables["hosts"].head()) == (1, "Ann")
