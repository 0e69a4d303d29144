"""Public price observations, catalogue items and wholesale prices as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import category_of, clean_text, distinct_from, first_en_tag
from tidemark.operators.incremental import top_per_group

ITEM = """struct<id:bigint,price:string,currency:string,date:string,created:string,duplicate_of:bigint,product_code:string,product_name:string,category_tag:string,price_per:string,
price_is_discounted:boolean,price_without_discount:string,location_id:bigint,location:struct<osm_name:string,osm_brand:string,osm_address_city:string,osm_address_country_code:string,osm_lat:double,osm_lon:double>,
product_id:bigint,product:struct<code:string,product_name:string,brands:string,categories_tags:array<string>,product_quantity:double,product_quantity_unit:string,nutriscore_grade:string>>"""
GRADES = ("a", "b", "c", "d", "e")


def _money(name: str):
    m = F.bround(F.col(name).try_cast("decimal(38,10)"), 2)
    return F.when((m > 0) & (m < 100_000_000_000), m.cast("decimal(14,2)"))


def normalise_observations(items: DataFrame) -> dict[str, DataFrame]:
    """locations, products, prices and rejected, from items of :data:`ITEM`'s fields. Of several items for one id the newest counts."""
    i = items.withColumns({"_price": _money("price"), "_currency": F.upper("currency")})
    bad = F.coalesce(F.col("duplicate_of") != 0, F.lit(False)) | F.col("_price").isNull() | ~F.coalesce(F.char_length("_currency") == 3, F.lit(False)) | (F.coalesce("date", F.lit("")) == "")
    good = i.filter(~bad)

    def newest(df: DataFrame, key: str, cols: dict) -> DataFrame:
        one = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*(v.alias(k) for k, v in cols.items())), F.struct("created", "id")).alias("r"))
        return one.select("r.*")

    text = lambda c, n=200: clean_text(F.col(c), n)
    locations = newest(good.filter("location is not null"), "location_id", {
        "location_id": F.col("location_id"), "osm_name": text("location.osm_name"), "brand": text("location.osm_brand", 80), "city": text("location.osm_address_city", 80),
        "country_code": F.upper(text("location.osm_address_country_code", 2)), "lat": F.col("location.osm_lat"), "lon": F.col("location.osm_lon"),
    })
    grade = F.col("product.nutriscore_grade")
    products = newest(good.filter("product is not null"), "product_id", {
        "market_product_id": F.col("product_id"), "code": F.coalesce(F.nullif("product.code", F.lit("")), "product_code", F.lit("")), "name": F.coalesce(text("product.product_name"), text("product_name")),
        "brand": clean_text(F.get(F.split("product.brands", ","), F.lit(0)), 80), "category_tag": first_en_tag(F.col("product.categories_tags")), "store_category": category_of(F.col("product.categories_tags")),
        "quantity": F.bround(F.col("product.product_quantity").cast("decimal(38,10)"), 3).cast("decimal(12,3)"), "quantity_unit": text("product.product_quantity_unit", 10), "nutriscore_grade": F.when(grade.isin(*GRADES), grade),
    })
    prices = newest(good, "id", {
        "price_id": F.col("id"), "market_product_id": F.when(F.col("product").isNotNull(), F.col("product_id")), "location_id": F.when(F.col("location").isNotNull(), F.col("location_id")), "product_code": text("product_code", 40),
        "category_tag": text("category_tag", 80), "price": F.col("_price"), "currency": F.col("_currency"), "is_discounted": F.coalesce("price_is_discounted", F.lit(False)), "price_without_discount": _money("price_without_discount"),
        "price_per": text("price_per", 20), "observed_on": F.substring("date", 1, 10).try_cast("date"), "source_created_at": F.col("created").try_cast("timestamp"),
    })
    return {"locations": locations, "products": products, "prices": prices, "rejected": items.join(good.select("id"), "id", "left_anti")}


def reprice_catalogue(products: DataFrame, prices: DataFrame, currency: str = "INR") -> DataFrame:
    """Catalogue rows whose selling price or provenance changes by the newest observation of their code, as they become."""
    newest = prices.filter((F.col("currency") == currency) & F.col("product_code").isNotNull()).groupBy("product_code").agg(F.max_by(F.struct("price", "price_without_discount"), F.struct("observed_on", "source_created_at", "price_id")).alias("n"))
    p = products.join(newest, F.col("off_code") == F.col("product_code"))
    p = p.filter(distinct_from([F.col("selling_price"), F.col("price_source")], [F.col("n.price"), F.lit("open_prices")]))
    mrp = F.greatest("mrp", "n.price", F.coalesce("n.price_without_discount", "n.price"))
    return p.withColumns({"mrp": mrp, "selling_price": F.col("n.price"), "price_source": F.lit("open_prices")}).select(*products.columns)


def link_catalogue(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Products whose SKU is OFF-<code> get that code, and grade and image of the catalogue item if there is one."""
    code = F.regexp_extract("sku", "^OFF-(.+)$", 1)
    c = catalogue.select(F.col("code").alias("_code"), F.col("nutriscore_grade").alias("_grade"), F.col("image_url").alias("_image"))
    p = products.withColumn("off_code", code).filter("off_code <> ''").join(c, F.col("off_code") == F.col("_code"), "left")
    return p.withColumns({"catalogue_source": F.lit("open_food_facts"), "nutriscore_grade": F.col("_grade"), "image_url": F.col("_image")}).drop("_code", "_grade", "_image")


def select_catalogue(items: DataFrame, per_category: int = 60, prefix: str = "890") -> DataFrame:
    """Usable items, once each, at most so many for a category; those priced locally (``priced``) first, then by code."""
    clean = lambda c, n=200: clean_text(F.col(c), n)
    grade = F.lower(clean("nutriscore_grade"))
    p = items.select(
        clean("code", 80).alias("code"), F.substring(F.coalesce(clean("product_name_en"), clean("product_name")), 1, 120).alias("name"), clean_text(F.get(F.split("brands", ","), F.lit(0)), 60).alias("brand"),
        F.coalesce(clean("quantity", 30), F.lit("1 pack")).alias("quantity"), category_of(F.col("categories_tags")).alias("category"), F.when(grade.isin(*GRADES), grade).alias("nutriscore_grade"),
        clean("image_front_small_url", 500).alias("image_url"), F.coalesce("priced", F.lit(False)).alias("has_inr_price"),
    )
    usable = p.filter((F.col("has_inr_price") | F.col("code").startswith(prefix)) & F.col("code").rlike("^[0-9]+$")).dropna(subset=["name", "brand", "category"])
    one = usable.groupBy("code").agg(F.max_by(F.struct(*(c for c in usable.columns if c != "code")), F.struct("has_inr_price", "name")).alias("r")).select("code", "r.*")
    return top_per_group(one, ["category"], [F.desc("has_inr_price"), F.col("code")], per_category)


def parse_mandi(records: DataFrame) -> DataFrame:
    """Wholesale records with a valid dd/MM/yyyy date, three prices of at least 0, a market and a commodity."""
    words = [F.coalesce(clean_text(F.col(c), 80), F.lit("")).alias(c) for c in ("state", "district", "market", "commodity", "variety", "grade")]
    money = [F.bround(F.col(c).try_cast("decimal(38,10)"), 2).cast("decimal(10,2)").alias(c) for c in ("min_price", "max_price", "modal_price")]
    day = F.to_date(F.try_to_timestamp(F.trim("arrival_date"), F.lit("dd/MM/yyyy"))).alias("arrival_date")
    out = records.select(*words, day, *money).dropna(subset=["arrival_date", "min_price", "max_price", "modal_price"])
    return out.filter((F.col("market") != "") & (F.col("commodity") != "") & (F.least("min_price", "max_price", "modal_price") >= 0))
