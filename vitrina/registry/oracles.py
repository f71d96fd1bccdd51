"""The registered queries as SQL over the same tables.

Written apart from the Spark code, with other functions, so that agreement means
something.
"""

from __future__ import annotations

from vitrina.functions.text import WHITESPACE
from vitrina.registry.catalogs import LINE_ITEMS, ORDER_ITEMS, raw_sql
from vitrina.spec import CLEAN_TYPES, DIMENSION_COUNTS

_TOKENS = "('', 'nan', 'null', 'none', 'n/a', 'na')"
_DIMENSIONS = DIMENSION_COUNTS
_LONGS = ("metacritic", "ratings_count", "reviews_count")
_DOUBLES = ("rating", "playtime")


def trim(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def norm(x: str) -> str:
    return f"CASE WHEN lower({trim(x)}) IN {_TOKENS} THEN NULL ELSE {trim(x)} END"


def missing(x: str) -> str:
    return f"({x} IS NULL OR lower({trim(x)}) IN {_TOKENS})"


def as_long(x: str) -> str:
    return f"CAST(trunc(try_cast({x} AS DOUBLE)) AS BIGINT)"


def as_double(x: str) -> str:
    return f"CASE WHEN isnan(try_cast({x} AS DOUBLE)) THEN NULL ELSE try_cast({x} AS DOUBLE) END"


def as_date(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def listed(x: str) -> str:
    elements = f"list_transform(string_split({x}, '|'), lambda e: {trim('e')})"
    return f"list_filter({elements}, lambda e: e <> '')"


def distinct(x: str) -> str:
    return f"list_filter({listed(x)}, lambda e, i: list_position({listed(x)}, e) = i)"


def joined(x: str) -> str:
    return f"CASE WHEN len({distinct(x)}) > 0 THEN array_to_string({distinct(x)}, '|') END"


def size(x: str) -> str:
    return f"CAST(coalesce(len({x}), 0) AS INTEGER)"


def clean_sql(columns, raw: str) -> str:
    """Clean catalog over a raw one named ``raw``."""
    names = [name for name, _ in columns]
    out = []
    for name in names:
        if name in ("id", "name", "slug"):
            out.append(name)
        elif name in _LONGS:
            out.append(f"{as_long(norm(name))} AS {name}")
        elif name in _DOUBLES:
            out.append(f"{as_double(norm(name))} AS {name}")
        elif name == "released":
            out.append(f"{as_date(norm(name))} AS {name}")
        elif name in _DIMENSIONS:
            out.append(f"{joined(name + '_text')} AS {name}")
        else:
            out.append(f"{norm(name)} AS {name}")
    out.append(f"CAST(year({as_date(norm('released'))}) AS INTEGER) AS release_year")
    if "esrb_rating" in names:
        out.append(f"{norm('esrb_rating')}->>'$.name' AS esrb_rating_name")
    out += [f"{size(distinct(name + '_text'))} AS {count}" for name, count in _DIMENSIONS.items()]
    texts = ", ".join(f"{norm(name)} AS {name}_text" for name in _DIMENSIONS)
    return f"SELECT {', '.join(out)} FROM (SELECT *, {texts} FROM {raw})"


def orders(body: str) -> str:
    """A query over ``raw`` and ``clean``, the catalogs of orders."""
    return (
        f"WITH raw AS ({raw_sql(ORDER_ITEMS, 'orders')}), "
        f"clean AS MATERIALIZED ({clean_sql(ORDER_ITEMS, 'raw')}){_continue(body)}"
    )


def lines(body: str) -> str:
    """A query over ``raw`` and ``clean``, the catalogs of order lines."""
    return (
        f"WITH raw AS ({raw_sql(LINE_ITEMS, 'lineitem')}), "
        f"clean AS MATERIALIZED ({clean_sql(LINE_ITEMS, 'raw')}){_continue(body)}"
    )


def _continue(body: str) -> str:
    """Further WITH parts start with a comma, a plain query does not."""
    body = body.strip()
    return f" {body}" if body.upper().startswith("SELECT") else f", {body}"


# The contract


def top_sql(dimension: str) -> str:
    return (
        f"SELECT {dimension}, count(DISTINCT id) AS videojuegos "
        f"FROM (SELECT id, unnest(string_split({dimension}, '|')) AS {dimension} FROM clean) "
        f"GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
    )


def metric_sql(metric: str, support: int, maximum: bool = False) -> str:
    extra = f", max(m) AS {metric}_maximo" if maximum else ""
    return f"""
        pairs AS (
            SELECT id, genres, max(m) AS m FROM (
                SELECT id, {metric} AS m, unnest(string_split(genres, '|')) AS genres
                FROM clean WHERE genres IS NOT NULL AND {metric} IS NOT NULL
            ) GROUP BY 1, 2)
        SELECT genres, count(*) AS juegos_con_{metric},
            round_even(avg(m), 4) AS {metric}_promedio,
            round_even(median(m), 4) AS {metric}_mediano{extra}
        FROM pairs GROUP BY 1 HAVING count(*) >= {support}
        ORDER BY 3 DESC, 1 LIMIT 20"""


CONTRACT = {
    "q01_overview": """
        SELECT count(*) AS total_registros, count(DISTINCT id) AS ids_unicos,
            min(release_year) AS anio_minimo, max(release_year) AS anio_maximo,
            count(rating) AS juegos_con_rating, count(metacritic) AS juegos_con_metacritic,
            count(genres) AS juegos_con_genero, count(platforms) AS juegos_con_plataforma
        FROM clean""",
    "q02_items_per_year": """
        SELECT release_year, count(DISTINCT id) AS videojuegos
        FROM clean WHERE release_year IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "q03_top_genres": top_sql("genres"),
    "q04_top_platforms": top_sql("platforms"),
    "q05_top_developers": top_sql("developers"),
    "q06_rating_by_genre": metric_sql("rating", 50),
    "q07_metacritic_by_genre": metric_sql("metacritic", 20),
    "q08_top_items": """
        SELECT id, name, release_year, rating, ratings_count, reviews_count, genres
        FROM clean WHERE ratings_count IS NOT NULL ORDER BY ratings_count DESC, id LIMIT 20""",
    "q09_playtime_by_genre": metric_sql("playtime", 30, maximum=True),
    "q10_yearly_evolution": """
        SELECT release_year, count(DISTINCT id) AS videojuegos,
            count(rating) AS juegos_con_rating,
            round_even(avg(rating), 4) AS rating_promedio,
            count(metacritic) AS juegos_con_metacritic,
            round_even(avg(metacritic), 4) AS metacritic_promedio,
            CAST(coalesce(sum(ratings_count), 0) AS BIGINT) AS total_ratings
        FROM clean WHERE release_year IS NOT NULL GROUP BY 1 ORDER BY 1""",
}


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def share(part: str, whole: str = "count(*)") -> str:
    return f"round_even({part} * 100.0 / {whole}, 6)"


def inspect_sql(fields, source: str, minimum: int) -> str:
    return union(
        f"SELECT {index} AS orden, '{name}' AS columna, '{kind}' AS tipo, "
        f"count(*) - count({name}) AS nulos, {share(f'(count(*) - count({name}))')} AS porcentaje, "
        f"count(*) AS filas, count(*) >= {minimum} AS suficientes FROM {source}"
        for index, (name, kind) in enumerate(fields, start=1)
    )


_RAW_NAMES = tuple(name for name, _ in ORDER_ITEMS)
_RAW_TYPES = {
    **{name: "string" for name in _RAW_NAMES},
    **CLEAN_TYPES,
}
_CLEAN_FIELDS = [
    (name, _RAW_TYPES[name])
    for name in (*_RAW_NAMES, "release_year")
] + [("esrb_rating_name", "string")] + [(count, "int") for count in _DIMENSIONS.values()]

_LINEITEM_FIELDS = (
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
)

_PROFILED = (
    "released rating ratings_count metacritic playtime reviews_count platforms developers "
    "genres publishers esrb_rating tba"
).split()
_NUMERIC = ("rating", "playtime", "ratings_count", "metacritic", "reviews_count")
_SAMPLED = ("platforms", "developers", "genres", "tags", "publishers", "esrb_rating", "tba")


def describe_sql(places: int = 6) -> str:
    return union(
        f"SELECT '{name}' AS columna, min(v) AS min, max(v) AS max, "
        f"round_even(avg(v), {places}) AS mean, round_even(median(v), {places}) AS median "
        f"FROM (SELECT {as_double(trim(name))} AS v FROM raw)"
        for name in _NUMERIC
    )


_YEAR_BAD = "release_year IS DISTINCT FROM year(released)"
_RANGES = {
    "rating [0, 5]": "rating < 0 OR rating > 5 OR isnan(rating) OR isinf(rating)",
    "metacritic [0, 100]": "metacritic < 0 OR metacritic > 100",
    "playtime >= 0": "playtime < 0 OR isnan(playtime) OR isinf(playtime)",
}


def validate_sql(rows: int, columns: int, have: int, literals) -> str:
    def check(name: str, bad: str) -> str:
        return f"SELECT '{name}' AS verificacion, CAST({bad} AS BIGINT) AS n FROM clean"

    def matching(name: str, condition: str) -> str:
        return check(name, f"count(*) FILTER ({condition})")

    parts = [
        check("filas", f"abs(count(*) - {rows})"),
        check("columnas", f"any_value(abs({have} - {columns}))"),
        matching("id null", "id IS NULL"),
        matching("name null", "name IS NULL"),
        matching("slug null", "slug IS NULL"),
        matching("released vs release_year", _YEAR_BAD),
    ]
    for name, count in _DIMENSIONS.items():
        parts.append(matching(f"{name} normalizado", f"{name} IS DISTINCT FROM {joined(name)}"))
        parts.append(matching(count, f"{count} IS DISTINCT FROM {size(distinct(name))}"))
    parts += [matching(name, bad) for name, bad in _RANGES.items()]
    for name in CLEAN_TYPES:
        absent = int(name == "rating_top")
        parts.append(check(f"tipo {name}", f"any_value({absent})"))
    for key in ("id", "slug"):
        parts.append(
            f"SELECT '{key} duplicados', count(*) FROM "
            f"(SELECT {key} FROM clean WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        )
    for key, name, slug in literals:
        parts.append(
            f"SELECT 'literal {key}', count(*) FILTER (k IS NULL OR name <> '{name}' OR slug <> "
            f"'{slug}') FROM (SELECT 1) LEFT JOIN (SELECT id AS k, name, slug FROM clean) "
            f"ON k = {key}"
        )
    return f"SELECT verificacion, n AS incorrectos, n = 0 AS ok FROM ({union(parts)})"


def audit_sql(floats=("rating", "playtime")) -> str:
    empty = r"(^\s*\|)|(\|\s*$)|(\|\s*\|)"

    def finding(name: str, condition: str) -> str:
        return f"SELECT '{name}' AS auditoria, count(*) FILTER ({condition}) AS problemas FROM audited"

    parts = [finding(f"nan {name}", f"isnan({name})") for name in floats]
    parts.append(finding("rating", "rating < 0 OR rating > 5 OR isnan(rating)"))
    parts.append(finding("release_year", _YEAR_BAD))
    for name, count in _DIMENSIONS.items():
        parts.append(finding(f"vacios {name}", f"regexp_matches({name}, '{empty}')"))
        parts.append(finding(f"conteo {name}", f"coalesce({count}, -1) <> {size(distinct(name))}"))
        parts.append(pairs_sql(name, "audited"))
    return f"""found AS ({union(parts)})
        SELECT * FROM found UNION ALL
        SELECT 'total', CAST(sum(problemas) AS BIGINT) FROM found
        WHERE NOT starts_with(auditoria, 'nan ')"""


def pairs_sql(name: str, source: str) -> str:
    return (
        f"SELECT 'pares {name}' AS auditoria, count(*) AS problemas FROM ("
        f"SELECT id, v FROM (SELECT id, unnest({listed(name)}) AS v FROM {source}) "
        f"GROUP BY 1, 2 HAVING count(*) > 1)"
    )


_PAIR = """
    l AS (SELECT id, name, genres, rating, ratings_count FROM clean),
    r AS (SELECT id, CASE WHEN genres IS NULL THEN concat(name, ' (sin genero)') ELSE name END
            AS name, genres,
            CASE WHEN ratings_count > 7900 THEN rating + 0.5
                WHEN ratings_count > 7000 THEN rating + 0.00003::DOUBLE ELSE rating END AS rating,
            ratings_count
          FROM clean)"""


def _issue(column: str, bad: str, source: str, position: str, text: str) -> str:
    return f"""
        SELECT 'valores' AS problema, '{column}' AS columna,
            CAST(min({position}) AS BIGINT) AS posicion,
            arg_min({text.format('l.' + column)}, {position}) AS esperado,
            arg_min({text.format('r.' + column)}, {position}) AS actual, count(*) AS filas
        FROM {source} WHERE {bad} HAVING count(*) > 0"""


_TIDY = (
    "CASE WHEN abs({0} - round_even({0}, 0)) <= 1e-9 * greatest(abs({0}), abs(round_even({0}, 0)), 1) "
    "THEN round_even({0}, 0) ELSE round_even({0}, 4) END"
)


def _tidied(source: str) -> str:
    columns = ", ".join(f"CAST({_TIDY.format(c)} AS DOUBLE) AS {c}" for c in ("id", "rating", "ratings_count"))
    return f"SELECT {trim('name')} AS name, {trim('genres')} AS genres, {columns} FROM {source}"


def sorted_sql(left: str, right: str, columns, numeric) -> str:
    names = ", ".join(columns)
    order = ", ".join(f"{name} NULLS LAST" for name in columns)
    cells = []
    for index, name in enumerate(columns):
        same = (
            f"(a.{name} IS NOT DISTINCT FROM b.{name} OR coalesce(abs(a.{name} - b.{name}) <= 1e-4, false))"
            if name in numeric
            else f"a.{name} IS NOT DISTINCT FROM b.{name}"
        )
        cells.append(
            f"SELECT {index} AS k, fila, '{name}' AS columna, CAST(a.{name} AS VARCHAR) AS referencia, "
            f"CAST(b.{name} AS VARCHAR) AS candidato FROM a JOIN b USING (fila) WHERE NOT {same}"
        )
    return f"""
        a AS (SELECT {names}, row_number() OVER (ORDER BY {order}) - 1 AS fila FROM ({left})),
        b AS (SELECT {names}, row_number() OVER (ORDER BY {order}) - 1 AS fila FROM ({right}))
        SELECT fila, columna, referencia, candidato FROM ({union(cells)}) ORDER BY k, fila LIMIT 10"""


def order_sql(name: str, violation: str) -> str:
    return f"""
        SELECT '{name}' AS orden, count(*) AS pares, count(*) FILTER ({violation}) AS violaciones,
            count(*) FILTER ({violation}) = 0 AS ok
        FROM (SELECT *, lag(posicion) OVER w AS p, lag(id) OVER w AS p_id, lag(rc) OVER w AS p_rc
              FROM ranked WINDOW w AS (ORDER BY posicion)) WHERE p IS NOT NULL"""


def words_sql(table: str) -> str:
    return (
        f"SELECT CAST(length(w) AS BIGINT) AS len, count(*) AS freq FROM "
        f"(SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS w FROM {table}) "
        f"WHERE w <> '' GROUP BY 1"
    )


def word_stats_sql(table: str) -> str:
    return f"""
        WITH h AS ({words_sql(table)}),
        c AS (SELECT *, sum(freq) OVER (ORDER BY len) AS upto, sum(freq) OVER () AS n FROM h)
        SELECT CAST(sum(freq) AS BIGINT) AS total_tokens,
            CAST(sum(len * freq) AS BIGINT) AS suma_longitudes,
            round_even(sum(len * freq) / sum(freq), 6) AS media,
            (min(len) FILTER (upto >= (n + 1) // 2) + min(len) FILTER (upto >= (n + 2) // 2)) / 2.0
                AS mediana,
            round_even(sqrt(sum(len * len * freq) / sum(freq)
                - (sum(len * freq) / sum(freq)) ** 2), 6) AS desviacion_estandar,
            CAST(sum(len * len * freq) AS BIGINT) AS suma_cuadrados
        FROM c"""


_VISIBLE = "id, name, slug, rating"
_NEW_ROW = (
    "SELECT max(id) + 1 AS id, 'DEMO ITEM' AS name, concat('demo-', max(id) + 1) AS slug, "
    "3.0::DOUBLE AS rating FROM clean"
)
_LITERALS = ((1, "NULL", "item-1"), (2, "None", "item-2"), (3, "NaN", "item-3"))


def oracles() -> dict[str, str]:
    """SQL per registered query."""
    sql: dict[str, str] = {
        "clean_catalog": orders("SELECT * FROM clean"),
        "clean_line_catalog": lines("SELECT * FROM clean"),
    }
    names = ("released", "rating", "genres", "platforms", "publishers", "esrb_rating", "tba")
    sql["missing_tokens"] = orders(
        "SELECT id, "
        + ", ".join(f"{missing(name)} AS {name}_missing" for name in names)
        + ", "
        + ", ".join(f"{norm(name)} AS {name}" for name in names)
        + f", NOT {missing('developers')} AS developers_valid FROM raw"
    )
    sql["lenient_casts"] = orders(
        f"SELECT id, {as_long('metacritic')} AS metacritic, "
        f"{as_long('ratings_count')} AS ratings_count, {as_double('rating')} AS rating, "
        f"{as_double('playtime')} AS playtime, {as_date('released')} AS released FROM raw"
    )
    sql["json_field_catalog"] = orders(
        f"SELECT id, {norm('esrb_rating')}->>'$.name' AS esrb_rating_name FROM raw"
    )
    sql["json_field_events"] = "SELECT event_id, props->>'$.k' AS k FROM events"
    sql["dimension_normalise"] = orders(
        "SELECT id, "
        + ", ".join(f"{joined(f'({norm(name)})')} AS {name}" for name in _DIMENSIONS)
        + " FROM raw"
    )
    columns = []
    for name, count in _DIMENSIONS.items():
        text = f"({norm(name)})"
        columns += [
            f"{size(distinct(text))} AS {count}",
            f"{size(listed(text))} AS {name}_listed",
            f"CAST(length({text}) - length(replace({text}, '|', '')) AS INTEGER) AS {name}_pipes",
        ]
    sql["dimension_counts"] = orders(f"SELECT id, {', '.join(columns)} FROM raw")
    sql["dimension_empty_tokens"] = orders(
        union(
            f"SELECT '{name}' AS columna, count(*) FILTER (list_contains(list_transform("
            f"string_split({name}, '|'), lambda e: {trim('e')}), '') AND contains({name}, '|')) "
            f"AS filas_con_vacios FROM raw"
            for name in _DIMENSIONS
        )
    )
    sql["text_preview"] = (
        "SELECT doc_id, CASE WHEN length(text) > 500 THEN concat(substr(text, 1, 500), '...') "
        "ELSE text END AS vista FROM documents"
    )
    sql["explode_genres"] = orders(
        "SELECT DISTINCT id, rating, metacritic, unnest(string_split(genres, '|')) AS genres "
        "FROM clean WHERE genres IS NOT NULL"
    )
    sql["explode_genres_repeated_ids"] = lines(
        "SELECT id, genres, max(rating) AS rating FROM (SELECT id, rating, "
        "unnest(string_split(genres, '|')) AS genres FROM clean) GROUP BY 1, 2"
    )

    for name, body in CONTRACT.items():
        sql[name] = orders(body)
        if name != "q08_top_items":
            sql[f"{name}_repeated_ids"] = lines(body)
    sql["q06_rating_by_genre_split"] = sql["q06_rating_by_genre"]
    sql["q09_playtime_by_genre_split"] = sql["q09_playtime_by_genre_repeated_ids"]
    sql["price_median_by_flag_split"] = (
        "SELECT l_returnflag, count(*) AS n, round_even(avg(l_extendedprice), 2) AS mean, "
        "round_even(median(l_extendedprice), 6) AS median, min(l_extendedprice) AS low, "
        "max(l_extendedprice) AS high FROM lineitem GROUP BY 1"
    )
    sql["aligned_aggregates"] = orders(
        """pairs AS (SELECT DISTINCT id, rating, metacritic,
                unnest(string_split(genres, '|')) AS genres FROM clean),
            a AS (SELECT genres, count(*) AS con_rating, round_even(avg(rating), 4)
                AS rating_promedio FROM pairs WHERE rating IS NOT NULL GROUP BY 1),
            b AS (SELECT genres, count(*) AS con_metacritic, round_even(avg(metacritic), 4)
                AS metacritic_promedio FROM pairs WHERE metacritic IS NOT NULL GROUP BY 1)
        SELECT genres, coalesce(con_rating, 0) AS con_rating, rating_promedio,
            coalesce(con_metacritic, 0) AS con_metacritic, metacritic_promedio
        FROM (SELECT DISTINCT genres FROM pairs) LEFT JOIN a USING (genres)
            LEFT JOIN b USING (genres)"""
    )
    counted = union(
        f"SELECT 'q{number:02d}' AS query_id, count(*) AS filas_resultado FROM "
        f"({'WITH ' if not body.strip().startswith('SELECT') else ''}{body})"
        for number, body in enumerate(CONTRACT.values(), start=1)
    )
    sql["suite_results"] = orders(f"SELECT * FROM ({counted})")
    sql["suite_summary"] = suite_summary_sql()

    sql["inspect_catalog"] = orders(inspect_sql(_CLEAN_FIELDS, "clean", 1000))
    sql["inspect_lineitem"] = inspect_sql(_LINEITEM_FIELDS, "lineitem", 500000)
    sql["null_profile_raw"] = orders(
        union(
            f"SELECT '{name}' AS columna, count(*) - count({name}) AS nulos, count(*) AS filas, "
            f"{share(f'(count(*) - count({name}))')} AS porcentaje FROM raw"
            for name in _RAW_NAMES
        )
    )
    sql["semantic_missing_profile"] = orders(
        union(
            f"SELECT '{name}' AS columna, count(*) FILTER ({missing(name)}) AS faltantes, "
            f"count(*) AS filas, {share(f'count(*) FILTER ({missing(name)})')} AS porcentaje FROM raw"
            for name in _PROFILED
        )
    )
    sql["numeric_validity"] = orders(
        union(
            f"SELECT '{name}' AS columna, "
            f"count(*) FILTER (NOT {missing(name)} AND try_cast({trim(name)} AS DOUBLE) IS NOT NULL) "
            f"AS validos, count(*) FILTER ({missing(name)}) AS faltantes, "
            f"count(*) FILTER (NOT {missing(name)} AND try_cast({trim(name)} AS DOUBLE) IS NULL) "
            f"AS invalidos FROM raw"
            for name in _NUMERIC
        )
    )
    date = as_date(trim("released"))
    sql["date_validity"] = orders(
        f"SELECT count(*) FILTER ({missing('released')}) AS faltantes, "
        f"count(*) FILTER (NOT {missing('released')} AND {date} IS NOT NULL) AS fechas_validas, "
        f"count(*) FILTER (NOT {missing('released')} AND {date} IS NULL) AS fechas_invalidas FROM raw"
    )
    sql["date_range"] = orders(
        f"SELECT min({date}) AS fecha_minima, max({date}) AS fecha_maxima FROM raw"
    )
    sql["numeric_describe"] = orders(describe_sql())
    sql["numeric_describe_split"] = lines(describe_sql())
    sql["sample_values"] = orders(
        union(
            f"SELECT '{name}' AS columna, CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS orden, "
            f"v AS valor FROM (SELECT DISTINCT {norm(name)} AS v FROM raw) WHERE v IS NOT NULL "
            f"QUALIFY row_number() OVER (ORDER BY v) <= 5"
            for name in _SAMPLED
        )
    )
    sql["value_frequency"] = orders(
        f"SELECT lower({norm('tba')}) AS tba, count(*) AS len FROM raw "
        f"WHERE NOT {missing('tba')} GROUP BY 1"
    )
    sql["first_catalog_rows"] = orders(
        f"SELECT {_VISIBLE}, genres FROM clean ORDER BY id LIMIT 1000"
    )
    sql["duplicate_key_summary"] = lines(
        union(
            f"SELECT '{key}' AS clave, count(*) AS duplicados, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS filas_en_grupos_duplicados, "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS filas_extra FROM "
            f"(SELECT count(*) AS n FROM raw GROUP BY {key} HAVING count(*) > 1)"
            for key in ("id", "slug")
        )
    )
    sql["duplicate_event_keys"] = (
        "SELECT user_id, event_type, count(*) AS cantidad FROM events GROUP BY 1, 2 "
        "HAVING count(*) > 1"
    )
    sql["slug_collision_members"] = lines(
        "SELECT slug, id, name, count(*) AS veces, CAST(any_value(t) AS BIGINT) AS cantidad FROM "
        "(SELECT *, count(*) OVER (PARTITION BY slug) AS t FROM clean) WHERE t > 1 GROUP BY 1, 2, 3"
    )
    groups = """
        SELECT {shown} AS {key}, CAST(sum(n) AS BIGINT) AS cantidad, CAST(0 AS INTEGER) AS parte,
            string_agg(CAST({member} AS VARCHAR), ',' ORDER BY {member}, {label}) AS ids,
            string_agg({label}, ',' ORDER BY {member}, {label}) AS nombres,
            string_agg(CAST(n AS VARCHAR), ',' ORDER BY {member}, {label}) AS veces
        FROM (SELECT {key} AS k, {member}, {label}, count(*) AS n FROM {source} GROUP BY 1, 2, 3)
        GROUP BY k HAVING sum(n) > 1"""
    sql["slug_collisions"] = lines(
        groups.format(shown="k", key="slug", member="id", label="name", source="clean")
    )
    sql["text_collisions"] = groups.format(
        shown="md5(k)", key="text", member="doc_id", label="source", source="documents"
    )
    sql["rows_without_slug"] = orders(
        "SELECT id, name, slug FROM raw WHERE id IN (SELECT id FROM clean WHERE genres IS NULL)"
    )

    sql["validate_catalog"] = orders(validate_sql(899585, 22, 22, _LITERALS))
    sql["validate_line_catalog"] = lines(
        validate_sql(
            899585,
            60,
            18,
            ((100122, "NULL", "null"), (468408, "None", "none"), (119609, "NaN", "nan")),
        )
    )
    dims = ", ".join(f"raw.{name}" for name in _DIMENSIONS)
    sql["audit_catalog"] = orders(
        f"audited AS (SELECT clean.* EXCLUDE ({', '.join(_DIMENSIONS)}), {dims} "
        f"FROM clean JOIN raw ON raw.id = clean.id), {audit_sql()}"
    )
    sql["audit_line_catalog"] = lines(f"audited AS (SELECT * FROM clean), {audit_sql()}")
    sql["repeated_pairs"] = lines(union(pairs_sql(name, "clean") for name in _DIMENSIONS))
    sql["value_ranges"] = lines(
        union(
            f"SELECT '{name}' AS columna, CAST(min({name}) AS VARCHAR) AS minimo, "
            f"CAST(max({name}) AS VARCHAR) AS maximo FROM clean"
            for name in ("rating", "metacritic", "playtime", "released")
        )
    )
    sql["health_gate"] = lines(
        "SELECT verificacion, actual, esperado, actual = esperado AS ok FROM ("
        + union(
            f"SELECT '{name}' AS verificacion, CAST({actual} AS BIGINT) AS actual, "
            f"CAST({value} AS BIGINT) AS esperado FROM clean"
            for name, actual, value in (
                ("filas", "count(*)", 899585),
                ("ids unicos", "count(DISTINCT id)", 899585),
                ("anio minimo", "min(release_year)", 1954),
                ("anio maximo", "max(release_year)", 2033),
            )
        )
        + ")"
    )
    sql["literal_lookup"] = orders(
        """expected(id, name, slug) AS (VALUES (1, 'NULL', 'item-1'), (2, 'None', 'item-2'),
            (3, 'NaN', 'item-3'), (-1, 'absent', 'absent'))
        SELECT CAST(e.id AS BIGINT) AS id, e.name, e.slug, c.name AS actual_name,
            c.slug AS actual_slug, coalesce(c.name = e.name AND c.slug = e.slug, false) AS ok
        FROM expected e LEFT JOIN clean c ON c.id = e.id"""
    )

    joined_pair = "l JOIN r ON l.id = r.id"
    sql["compare_ordered_catalogs"] = orders(
        _PAIR
        + _issue("name", "l.name <> r.name", joined_pair, "l.id", "{}")
        + " UNION ALL "
        + _issue(
            "rating", "abs(l.rating - r.rating) > 1e-4", joined_pair, "l.id", "CAST({} AS VARCHAR)"
        )
    )
    result = metric_sql("rating", 50).replace("pairs", "{0}_pairs").replace("FROM clean", "FROM {0}")
    ranked = "SELECT *, row_number() OVER (ORDER BY rating_promedio DESC, genres) - 1 AS p FROM ({})"

    def rows_of(source: str) -> str:
        return ranked.format("WITH " + result.format(source))

    both = "l JOIN r ON l.p = r.p"
    sql["compare_ordered_results"] = orders(
        "shifted AS (SELECT * REPLACE (rating * 1.01::DOUBLE AS rating) FROM clean), "
        f"l AS ({rows_of('clean')}), r AS ({rows_of('shifted')}) "
        + " UNION ALL ".join(
            [
                _issue("genres", "l.genres <> r.genres", both, "l.p", "{}"),
                *(
                    _issue(
                        name, f"abs(l.{name} - r.{name}) > 1e-4", both, "l.p", "CAST({} AS VARCHAR)"
                    )
                    for name in ("juegos_con_rating", "rating_promedio", "rating_mediano")
                ),
            ]
        )
    )
    sql["compare_multiset_catalogs"] = orders(
        _PAIR
        + f""", a AS ({_tidied('l')}), b AS ({_tidied('r')}),
        s AS (SELECT *, 1 AS sign FROM a UNION ALL BY NAME SELECT *, -1 AS sign FROM b)
        SELECT id, name, genres, rating, ratings_count, CAST(sum(sign) AS BIGINT) AS saldo
        FROM s GROUP BY ALL HAVING sum(sign) <> 0"""
    )
    keys = "l_returnflag, l_linestatus, l_linenumber"
    sql["multiset_difference_lines"] = f"""
        WITH a AS (SELECT {keys}, count(*) AS n FROM lineitem GROUP BY ALL),
        b AS (SELECT CASE l_returnflag WHEN 'A' THEN 'R' ELSE l_returnflag END AS l_returnflag,
            l_linestatus, l_linenumber, count(*) AS m FROM lineitem GROUP BY 1, 2, 3)
        SELECT {keys}, coalesce(n, 0) - coalesce(m, 0) AS saldo
        FROM a FULL JOIN b USING ({keys}) WHERE coalesce(n, 0) <> coalesce(m, 0)"""
    sql["fingerprint_difference_lines"] = """
        WITH s AS (SELECT *, 1 AS sign FROM lineitem
            UNION ALL SELECT * REPLACE (
                CASE l_orderkey WHEN 7 THEN l_discount + 1 ELSE l_discount END AS l_discount), -1
            FROM lineitem
            UNION ALL SELECT *, -1 FROM lineitem WHERE l_orderkey = 32)
        SELECT * EXCLUDE (sign), CAST(sum(sign) AS BIGINT) AS saldo
        FROM s GROUP BY ALL HAVING sum(sign) <> 0"""
    sql["compare_sorted_catalogs"] = orders(
        _PAIR
        + ", "
        + sorted_sql(
            "SELECT * FROM l",
            "SELECT * FROM r",
            ("ratings_count", "rating", "name", "genres"),
            ("ratings_count", "rating"),
        )
    )
    sql["compare_sorted_copies"] = "WITH " + sorted_sql(
        "SELECT l_returnflag, l_linestatus, l_tax FROM lineitem",
        "SELECT l_returnflag, l_linestatus, l_tax + 0.01::DOUBLE AS l_tax FROM lineitem",
        ("l_returnflag", "l_linestatus", "l_tax"),
        ("l_tax",),
    )
    sql["compare_aligned_lines"] = """
        WITH a AS (SELECT l_returnflag AS f, l_linestatus AS s, l_quantity AS q, l_tax AS t FROM lineitem),
        b AS (SELECT l_returnflag AS f, l_linestatus AS s, l_quantity AS q,
            CASE WHEN l_orderkey % 89 = 0 THEN l_tax + 0.01::DOUBLE ELSE l_tax END AS t
            FROM lineitem WHERE l_orderkey % 97 <> 0),
        x AS (SELECT *, row_number() OVER (PARTITION BY f, s ORDER BY q, t) - 1 AS nr, true AS hay
            FROM (FROM a EXCEPT ALL FROM b)),
        y AS (SELECT *, row_number() OVER (PARTITION BY f, s ORDER BY q, t) - 1 AS nr, true AS hay
            FROM (FROM b EXCEPT ALL FROM a)),
        p AS (SELECT coalesce(x.f, y.f) AS l_returnflag, coalesce(x.s, y.s) AS l_linestatus,
            coalesce(x.nr, y.nr) AS fila, x.hay AS a, y.hay AS b, x.q AS aq, x.t AS ta, y.q AS bq, y.t AS tb
            FROM x FULL JOIN y ON x.f = y.f AND x.s = y.s AND x.nr = y.nr)
        SELECT l_returnflag, l_linestatus, fila, CASE WHEN b IS NULL THEN 'falta' ELSE 'sobra' END AS problema,
            NULL::VARCHAR AS columna, CASE WHEN a THEN concat(aq, '|', ta) END AS referencia,
            CASE WHEN b THEN concat(bq, '|', tb) END AS candidato FROM p WHERE a IS NULL OR b IS NULL
        UNION ALL SELECT l_returnflag, l_linestatus, fila, 'valor', 'l_quantity', aq::VARCHAR, bq::VARCHAR
            FROM p WHERE a AND b AND abs(aq - bq) > 1e-4
        UNION ALL SELECT l_returnflag, l_linestatus, fila, 'valor', 'l_tax', ta::VARCHAR, tb::VARCHAR
            FROM p WHERE a AND b AND abs(ta - tb) > 1e-4
        UNION ALL SELECT NULL, NULL, NULL, 'filas', NULL, n::VARCHAR, m::VARCHAR
            FROM (SELECT count(*) AS n FROM a), (SELECT count(*) AS m FROM b) WHERE n <> m"""
    sql["sorted_positions"] = (
        "SELECT o_orderkey, o_totalprice, "
        "row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS posicion FROM orders"
    )
    sql["order_contract_catalog"] = orders(
        """ranked AS (SELECT id, ratings_count AS rc, row_number() OVER
            (ORDER BY ratings_count DESC NULLS LAST, id) - 1 AS posicion FROM clean)"""
        + order_sql(
            "ratings_count desc, id",
            "coalesce(rc > p_rc, rc IS NOT NULL AND p_rc IS NULL) "
            "OR (rc IS NOT DISTINCT FROM p_rc AND id < p_id)",
        )
        + " UNION ALL "
        + order_sql("id", "id < p_id")
    )

    sql["crud_next_id"] = orders("SELECT max(id) + 1 AS next_id FROM clean")
    sql["crud_create"] = orders(f"SELECT * FROM clean UNION ALL BY NAME ({_NEW_ROW})")
    sql["crud_read"] = lines("SELECT * FROM clean WHERE id = 7")
    sql["crud_update"] = orders(
        "SELECT * REPLACE (CASE WHEN id = 7 THEN 'renamed' ELSE name END AS name, "
        "CASE WHEN id = 7 THEN 4.5::DOUBLE ELSE rating END AS rating) FROM clean"
    )
    sql["crud_update_many"] = orders(
        "SELECT clean.* REPLACE ("
        "CASE WHEN c_custkey IS NULL THEN name WHEN c_acctbal > 0 THEN c_name END AS name, "
        "CASE WHEN c_custkey IS NULL THEN rating ELSE c_acctbal END AS rating) "
        "FROM clean LEFT JOIN customer ON c_custkey = id"
    )
    sql["crud_delete"] = lines("SELECT * FROM clean WHERE id <> 7")
    sql["crud_delete_many"] = orders(
        "SELECT * FROM clean WHERE id NOT IN (SELECT c_custkey FROM customer)"
    )
    sql["crud_summary"] = orders(
        union(
            f"SELECT '{stage}' AS etapa, count(*) + {more} AS filas, max(id) + 1 AS id_prueba, "
            f"CAST({more} AS BIGINT) AS coincidencias FROM clean"
            for stage, more in (
                ("00_antes", 0),
                ("01_create", 1),
                ("02_read", 1),
                ("03_update", 1),
                ("04_delete", 0),
            )
        )
    )

    readers = "(VALUES ('entero'), ('por_partes')) AS r(lector)"
    sql["csv_roundtrip_documents"] = (
        f"SELECT lector, doc_id, lang, source, n_chars, md5(text) AS texto_md5 FROM documents, {readers}"
    )
    sql["csv_roundtrip_orders"] = (
        f"SELECT lector, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders, {readers}"
    )
    sql["lines_in_small_splits"] = (
        "SELECT l_returnflag, l_linestatus, count(*) AS lineas, max(l_orderkey) AS ultimo_pedido "
        "FROM lineitem GROUP BY ALL"
    )
    numbers = ("id", "release_year", "rating", "ratings_count", "reviews_count")
    doubles = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in numbers)
    sql["typed_report"] = f"SELECT * REPLACE ({doubles}) FROM ({sql['q08_top_items']})"
    sql["priority_report"] = (
        "SELECT o_orderpriority AS prioridad, count(*) AS pedidos, max(o_totalprice) AS mayor "
        "FROM orders GROUP BY 1 ORDER BY 1"
    )
    sql["document_word_lengths"] = words_sql("documents")
    sql["document_word_stats"] = word_stats_sql("documents")
    sql["conversation_word_stats"] = word_stats_sql("conversations")
    sql["event_timing_rollup"] = """
        WITH e AS (SELECT CAST(user_id AS VARCHAR) AS motor FROM events
            UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer),
        t AS (SELECT CAST(user_id AS VARCHAR) AS motor, sum(value) AS s FROM events GROUP BY 1)
        SELECT motor, round_even(s, 4) AS tiempo_segundos,
            round_even(s / (SELECT min(s) FROM t), 4) AS vs_mas_rapido
        FROM e LEFT JOIN t USING (motor)"""
    sql["event_log_totals"] = (
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS tiempo_segundos "
        "FROM events"
    )
    sql["event_engine_times"] = (
        "SELECT CAST(event_id AS VARCHAR) AS motor, event_type AS entorno, "
        "value AS tiempo_segundos, "
        "CASE WHEN event_type <> 'error' THEN 'registro' ELSE 'reporte' END AS fuente FROM events "
        "UNION ALL SELECT 'c' || c_custkey, c_mktsegment, NULL, NULL FROM customer"
    )
    sql["suite_issues"] = suite_issues_sql()
    sql["long_ratings"] = orders(
        union(
            f"SELECT '{name}' AS columna, count({name}) AS validos, "
            f"CAST(max({name}) AS DOUBLE) AS maximo FROM clean"
            for name in ("rating", "metacritic", "playtime")
        )
    )
    return sql


def suite_issues_sql() -> str:
    """First differing row of each number column of the queries that have a fixed set of rows."""
    parts, issues = [], []
    numbers = {
        "q01": ("total_registros", ("juegos_con_rating",)),
        "q02": ("release_year", ("videojuegos",)),
        "q10": ("release_year", ("juegos_con_rating", "rating_promedio")),
    }
    for name, (order, columns) in numbers.items():
        body = next(body for key, body in CONTRACT.items() if key.startswith(name))
        head = "" if body.strip().startswith("SELECT") else "WITH "
        moved = body.replace("FROM clean", "FROM shifted")
        for label, text in ((name, body), (f"{name}s", moved)):
            parts.append(
                f"{label} AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS nr FROM ({head}{text}))"
            )
        for column in columns:
            issues.append(
                f"SELECT 'shifted' AS motor, '{name}' AS query_id, '{column}' AS columna, "
                "count(*) AS diferencias, min(nr) AS posicion, 'valor' AS problema, "
                f"CAST(arg_min(a.{column}, nr) AS DOUBLE) AS esperado, "
                f"CAST(arg_min(b.{column}, nr) AS DOUBLE) AS actual "
                f"FROM {name} AS a JOIN {name}s AS b USING (nr) "
                f"WHERE abs(a.{column} - b.{column}) > 1e-4 HAVING count(*) > 0"
            )
    return orders(
        "shifted AS (SELECT * REPLACE (CASE WHEN rating < 2 THEN rating + 1 ELSE rating END "
        f"AS rating) FROM clean), {', '.join(parts)} {' UNION ALL '.join(issues)}"
    )


def suite_summary_sql() -> str:
    """Queries that do not read the rating agree in all runs; the others differ when shifted.

    Whether a query differs is computed: each result is compared with the same query over
    the shifted catalog.
    """
    parts, tests = [], []
    for number, body in enumerate(CONTRACT.values(), start=1):
        head = "" if body.strip().startswith("SELECT") else "WITH "
        moved = body.replace("FROM clean", "FROM shifted")
        name = f"q{number:02d}"
        parts.append(f"{name} AS ({head}{body}), {name}s AS ({head}{moved})")
        tests.append(
            f"SELECT count(*) AS n FROM ((FROM {name} EXCEPT ALL FROM {name}s) "
            f"UNION ALL (FROM {name}s EXCEPT ALL FROM {name}))"
        )
    equal = f"SELECT count(*) FILTER (n = 0) AS equivalentes FROM ({union(tests)})"
    return orders(
        "shifted AS (SELECT * REPLACE (CASE WHEN rating < 2 THEN rating + 1 ELSE rating END "
        f"AS rating) FROM clean), {', '.join(parts)} "
        "SELECT 'general' AS motor, 10::BIGINT AS equivalentes, 10::BIGINT AS consultas, true AS ok "
        f"UNION ALL SELECT 'shifted', equivalentes, 10, equivalentes = 10 FROM ({equal})"
    )
