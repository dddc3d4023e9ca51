"""Fixture views: the shapes of the domain, derived from the given tables, in Spark's SQL and DuckDB's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "pages", "documents", "labels")


class Spark:
    @staticmethod
    def div(a: str, b: int) -> str:
        return f"(({a}) div {b})"

    text = "STRING"
    timestamp = "TIMESTAMP"

    @staticmethod
    def addresses(n: str, key: str) -> str:
        return f"transform(slice(array(1,2,3,4), 1, CAST({n} AS INT)), i -> concat({key}, ' Elm St Unit ', i))"

    @staticmethod
    def images(n: str, part: str, store: str) -> str:
        return f"transform(slice(array(0,1,2), 1, CAST({n} AS INT)), i -> concat('https://cdn.example.com/', {part}, '-', i, '.jpg?v=', {store}))"


class Duck:
    @staticmethod
    def div(a: str, b: int) -> str:
        return f"(({a}) // {b})"

    text = "VARCHAR"
    timestamp = "TIMESTAMP"

    @staticmethod
    def addresses(n: str, key: str) -> str:
        return f"list_transform([1,2,3,4][1:{n}], lambda i: concat({key}, ' Elm St Unit ', i))"

    @staticmethod
    def images(n: str, part: str, store: str) -> str:
        return f"list_transform([0,1,2][1:{n}], lambda i: concat('https://cdn.example.com/', {part}, '-', i, '.jpg?v=', {store}))"


def sql(d) -> dict[str, str]:
    """Each view over the ones before it and the given tables; d is the dialect."""
    h = "((pid * 31 + i * 17) % 10)"
    return {
        "seeds": f"SELECT page_id AS ord, CASE WHEN page_id % 3 = 0 THEN replace(url, '://', '://www.') ELSE url END AS store_url, concat('Store ', page_id % 50) AS store_name, {d.addresses('page_id % 5', 'page_id')} AS addresses FROM pages",
        "stores": f"SELECT s_suppkey + 1 AS id, concat(CASE WHEN s_suppkey % 2 = 0 THEN 'http' ELSE 'https' END, '://', CASE WHEN s_suppkey % 3 = 0 THEN 'www.' ELSE '' END, 'shop', {d.div('s_suppkey', 4)}, '.example.com') AS website, CAST({d.div('s_suppkey', 4)} AS BIGINT) AS shop_no, CASE WHEN s_nationkey % 7 = 0 THEN 'offline' ELSE 'online' END AS store_type, CASE WHEN s_suppkey % 4 <> 0 THEN concat('Unit ', s_suppkey % 4) END AS address, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_acctbal AS DOUBLE) / 100 END AS lat, s_name AS store_name FROM supplier",
        "products": f"SELECT l_suppkey + 1 AS store_id, CAST({d.div('l_suppkey', 4)} AS BIGINT) AS shop_no, l_partkey AS pid, CAST(l_partkey AS {d.text}) AS product_id, p_name AS item_name, p_type AS product_type, p_brand AS brand, CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * 100, 0) AS BIGINT) AS price_cents, p_size % 4 AS n_images, {d.images('p_size % 4', 'l_partkey', 'l_suppkey')} AS images, (l_partkey + l_suppkey) % 10 = 0 AS unavailable, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, l_partkey, p_name, p_type, p_brand, p_retailprice, p_size",
        "shop_products": "SELECT shop_no, pid, product_id, min(item_name) AS item_name, min(price_cents) AS price_cents, min(n_images) AS n_images, min(CASE WHEN unavailable THEN 1 ELSE 0 END) = 1 AS unavailable FROM products GROUP BY shop_no, pid, product_id",
        "scrape": "SELECT shop_no, product_id, item_name, price_cents + pid % 3 AS price_cents, n_images FROM shop_products WHERE (pid + shop_no) % 7 <> 0 AND shop_no % 11 <> 10 AND (shop_no % 6 <> 0 OR pid % 20 = 0) UNION ALL SELECT shop_no, CAST(pid + 1000000 AS " + d.text + "), item_name, price_cents, n_images FROM shop_products WHERE pid % 50 = 0 AND shop_no % 11 <> 10",
        "scrape_state": "SELECT DISTINCT shop_no, shop_no % 4 <> 0 AS complete FROM shop_products",
        "runs": f"SELECT run_id, website, status, error, updated_at FROM (SELECT o_orderpriority AS run_id, concat('https://shop', o_custkey % 400, '.example.com') AS website, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' ELSE CASE WHEN o_totalprice > 300000 THEN 'failed' ELSE 'scraped' END END AS status, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 300000 THEN concat('HTTP ', 400 + o_custkey % 5) END AS error, o_orderdate AS updated_at, row_number() OVER (PARTITION BY o_orderpriority, o_custkey % 400 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) AS last_orders WHERE rn = 1",
        "heartbeats": f"SELECT user_id AS store, CAST(ts AS {d.timestamp}) AS ts, event_type AS kind FROM events",
        "image_metrics": "SELECT p_partkey AS image_id, 300 + (p_partkey * 37) % 1500 AS width, 500 + (p_partkey * 53) % 1500 AS height, CAST((p_partkey * 7) % 60 AS DOUBLE) AS blur, CAST((p_partkey * 13) % 40 AS DOUBLE) / 10 AS tenengrad, CAST((p_partkey * 11) % 80 AS DOUBLE) AS patch_p90, CAST(p_partkey % 30 AS DOUBLE) / 100 AS edge_density, CAST((p_partkey * 17) % 256 AS DOUBLE) AS brightness, CAST(p_partkey % 100 AS DOUBLE) / 100 AS clipped, CAST((p_partkey * 19) % 60 AS DOUBLE) AS contrast, CAST(p_partkey % 101 AS DOUBLE) / 100 AS prob, 'JPEG' AS format, CAST(1000 AS BIGINT) AS bytes FROM part",
        "image_verdicts": f"SELECT store_id, product_id, i, concat('https://cdn.example.com/', product_id, '-', i, '.jpg?v=', store_id - 1) AS url, CASE {h} WHEN 5 THEN 'not_a_product_photo' WHEN 6 THEN 'resolution_too_low' WHEN 7 THEN 'image_too_blurry' WHEN 8 THEN 'timeout' WHEN 9 THEN 'fetch_error' END AS code, CAST((pid * 31 + i * 17) % 100 AS DOUBLE) / 100 AS prob FROM products JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2) AS n ON i < n_images",
        "prompts": "SELECT min(vec_id) AS vec_id, label FROM embeddings GROUP BY label",
        "geocode_candidates": f"SELECT c_custkey, p AS provider, concat(c_custkey % 200, ' Main St, ', 10000 + c_custkey % 90) AS address, CASE WHEN (c_custkey + p) % 4 <> 0 THEN concat(c_custkey % 200, ' Main Street ', 10000 + (c_custkey + p) % 90) END AS found, CAST(c_custkey + p AS DOUBLE) / 10 AS lat FROM customer CROSS JOIN (SELECT 0 AS p UNION ALL SELECT 1 UNION ALL SELECT 2) AS providers",
    }


#: What each view needs, itself last.
def needed(names: tuple[str, ...]) -> list[str]:
    order, views = list(sql(Duck)), sql(Duck)
    import re

    found: set[str] = set()
    todo = [n for n in names if n in views]
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += [v for v in order if v != name and re.search(rf"\b(?:FROM|JOIN) {v}\b", views[name])]
    return [n for n in order if n in found]


def oracle(names: tuple[str, ...], body: str) -> str:
    """DuckDB SQL of a query over fixture views."""
    views, body = sql(Duck), body.strip()
    given = ", ".join(f"{n} AS ({views[n]})" for n in needed(names))
    if not given:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {given}, {body[15:]}"
    return f"WITH {given}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {given} {body}"


class Views:
    """DataFrames of tables and fixture views of one folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self._known = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in BASE:
                self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text, views = sql(Spark)[name], sql(Spark)
                import re

                used = {v: getattr(self, v) for v in [*BASE, *views] if v != name and re.search(rf"\b(?:FROM|JOIN) {v}\b", text)}
                for v in used:
                    text = re.sub(rf"\b(FROM|JOIN) {v}\b", rf"\1 {{{v}}}", text)
                self._known[name] = self.spark.sql(text, **used)
        return self._known[name]
