"""The registered queries once more as SQL over the given tables, for the comparison."""

from __future__ import annotations

from retalake.schemas import BRONZE_COLUMNS, DIMENSIONS, FACT_TABLE, GOLD, SILVER, STAGING_TABLE

_RAW = """
raw AS (
  SELECT strftime(o_orderdate + to_hours(l_orderkey % 24), '%Y-%m-%d %H:%M:%S') AS "Timestamp do Registro",
         ' CLIENTE' AS "Nome",
         'da-silva ' || CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS "Sobrenome",
         CASE WHEN c_custkey % 50 = 0 THEN lower(replace(c_name, '#', '.'))
              ELSE lower(replace(c_name, '#', '.')) || '@' || lower(replace(r_name, ' ', '-')) || '.com'
         END AS "Email",
         CAST(c_custkey AS VARCHAR) AS "Telefone",
         p_name AS "Produto Adquirido",
         CASE WHEN CAST(l_extendedprice AS DECIMAL(18,2)) >= 100000
              THEN substr(price, 1, 3) || '.' || substr(price, 4) ELSE price END AS "Valor da Compra",
         c_mktsegment AS "Canal",
         o_orderpriority AS "Plataforma de Interação",
         l_returnflag || l_linestatus AS "Campanha de Marketing",
         CASE WHEN l_suppkey % 3 <> 0 THEN s_name END AS "Vendedor",
         CASE WHEN pct > 0 THEN CAST(pct AS VARCHAR) || '%' END AS "Desconto Oferecido",
         CASE WHEN pct > 0 THEN 'C' || CAST(pct % 3 AS VARCHAR) END AS "Código de Desconto Usado",
         'registros_' || lower(replace(r_name, ' ', '_')) AS "Arquivo de Origem"
  FROM (SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS pct,
               replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS price
        FROM lineitem) AS l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN (VALUES (1), (2), (3)) AS copies(n)
    ON n <= CASE WHEN l_quantity > 45 THEN 3 WHEN l_quantity > 40 THEN 2 ELSE 1 END
)"""

_TYPED = """
typed AS (
  SELECT * REPLACE (
    try_strptime("Timestamp do Registro", '%Y-%m-%d %H:%M:%S') AS "Timestamp do Registro",
    TRY_CAST(replace("Valor da Compra", ',', '.') AS FLOAT) AS "Valor da Compra",
    CAST(TRY_CAST(replace("Desconto Oferecido", '%', '') AS FLOAT) AS DOUBLE) / 100 AS "Desconto Oferecido"),
    CASE WHEN regexp_matches("Valor da Compra", '^[+-]?[0-9]+([.,][0-9]{0,2}0*)?$')
      THEN CAST(replace("Valor da Compra", ',', '.') AS DECIMAL(18,2)) END AS "Valor Exato",
    CAST("Valor Exato" * (1 - coalesce(CAST(replace("Desconto Oferecido", '%', '') AS DECIMAL(5,2)), 0) * 0.01) AS DECIMAL(28,8))
      AS liquido
  FROM raw
)"""

# Money is compared digit by digit, as text; it is computed from the texts of the landing files.
_TYPED_TEXT = '* EXCLUDE (liquido) REPLACE (CAST("Valor Exato" AS VARCHAR) AS "Valor Exato")'
_GOLD_TEXT = """* REPLACE (CAST(valor_exato AS VARCHAR) AS valor_exato,
  CAST(valor_liquido_exato AS VARCHAR) AS valor_liquido_exato)"""

_FILLED = """* REPLACE (
    coalesce("Desconto Oferecido", 0) AS "Desconto Oferecido",
    coalesce("Código de Desconto Usado", 'NÃO DISPONÍVEL') AS "Código de Desconto Usado",
    coalesce("Vendedor", 'NÃO INFORMADO') AS "Vendedor")"""

_SILVER = f"""
silver AS (
  SELECT {_FILLED}, CAST(year("Timestamp do Registro") AS INTEGER) AS "Ano"
  FROM (SELECT DISTINCT * FROM typed)
)"""


def _day_part(moment: str) -> str:
    return (
        f"CASE WHEN hour({moment}) < 6 THEN 'Madrugada' WHEN hour({moment}) < 12 THEN 'Manhã' "
        f"WHEN hour({moment}) < 18 THEN 'Tarde' WHEN {moment} IS NOT NULL THEN 'Noite' END"
    )


_GOLD = f"""
gold AS (
  SELECT "Timestamp do Registro" AS timestamp_do_registro,
         {_day_part('"Timestamp do Registro"')} AS turno_compra,
         "Nome" AS nome,
         "Sobrenome" AS sobrenome,
         array_to_string(list_transform(
           string_split(lower(concat_ws(' ', trim("Nome"), trim("Sobrenome"))), ' '),
           lambda w: upper(w[1]) || w[2:]), ' ') AS nome_completo,
         "Email" AS email,
         string_split("Email", '@')[2] AS dominio_email,
         "Telefone" AS telefone,
         "Produto Adquirido" AS produto_adquirido,
         "Valor da Compra" AS valor_da_compra,
         "Desconto Oferecido" AS desconto_oferecido,
         "Valor da Compra" * (1 - "Desconto Oferecido") AS valor_com_desconto,
         "Canal" AS canal,
         "Plataforma de Interação" AS plataforma_de_interacao,
         "Campanha de Marketing" AS campanha_de_marketing,
         "Vendedor" AS vendedor,
         "Código de Desconto Usado" AS codigo_de_desconto_usado,
         "Valor Exato" AS valor_exato,
         liquido AS valor_liquido_exato,
         "Arquivo de Origem" AS arquivo_de_origem,
         "Ano" AS ano
  FROM silver
)"""

_DIMS = ",".join(
    f"""
{d.table} AS (
  SELECT row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in d.key)}) - 1 AS {d.id}, *
  FROM (SELECT DISTINCT {", ".join(d.key)} FROM gold)
)"""
    for d in DIMENSIONS
)


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts) + "\n"


_TO_TYPED = _with(_RAW, _TYPED)
_TO_SILVER = _with(_RAW, _TYPED, _SILVER)
_TO_GOLD = _with(_RAW, _TYPED, _SILVER, _GOLD)
_TO_DIMS = _with(_RAW, _TYPED, _SILVER, _GOLD, _DIMS)


def _fact(legacy_keys: bool) -> str:
    joins = []
    for d in DIMENSIONS:
        if legacy_keys and d.table == "dim_cliente":
            condition = "g.nome_completo = dim_cliente.nome_completo AND g.email = g.email"
        elif legacy_keys:
            condition = f"g.{d.key[0]} = {d.table}.{d.key[0]}"
        else:
            condition = " AND ".join(f"g.{c} IS NOT DISTINCT FROM {d.table}.{c}" for c in d.key)
        joins.append(f"JOIN {d.table} ON {condition}")
    return f"""
  SELECT g.timestamp_do_registro, g.ano, cliente_id, produto_id, canal_id, plataforma_id, campanha_id,
         vendedor_id, desconto_id, CAST(g.valor_da_compra AS DOUBLE) AS valor_da_compra, g.turno_compra,
         g.valor_com_desconto, CAST(g.valor_exato AS VARCHAR) AS valor_exato,
         CAST(g.valor_liquido_exato AS VARCHAR) AS valor_liquido_exato, g.arquivo_de_origem
  FROM gold AS g
  {" ".join(joins)}"""


_BY_DAYPART_AND_YEAR = """
SELECT ano, turno_compra, count(*) AS vendas,
       CAST(round(sum(valor_liquido_exato), 2) AS DOUBLE) AS valor_liquido
FROM gold GROUP BY ano, turno_compra"""

_BY_SOURCE = """
SELECT arquivo_de_origem, count(arquivo_de_origem) AS registros FROM gold GROUP BY arquivo_de_origem"""


def _per_column(source: str, expression: str, columns: list[str], name: str) -> str:
    """One aggregated row, turned into one row per column."""
    counts = ", ".join(f"{expression.format(c=c)} AS \"{c}\"" for c in columns)
    return f"""
SELECT coluna, {name} FROM (UNPIVOT (SELECT {counts} FROM {source})
ON {", ".join(f'"{c}"' for c in columns)} INTO NAME coluna VALUE {name})"""


def _orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{key}' AS coluna, count(*) AS orfaos FROM {child}
WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"""


def _oracles() -> dict[str, str]:
    bronze = [*BRONZE_COLUMNS, "Arquivo de Origem"]
    all_columns = ", ".join(f'"{c}"' for c in bronze)
    raw_columns = ", ".join(f'"{c}"' for c in BRONZE_COLUMNS)
    spark_types = {f.name: f.dataType.simpleString() for f in SILVER}
    type_of = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in spark_types.items())
    dim_counts = " UNION ALL ".join(
        f"SELECT '{d.table}' AS tabela, count(*) AS registros FROM {d.table}" for d in DIMENSIONS
    )
    file = "'registros.' || replace(\"Canal\", ' ', '_')"
    stamp = "strftime(CAST(\"Timestamp do Registro\" AS TIMESTAMP), '%Y%m%d_%H%M%S')"
    fact_with = _TO_DIMS.rstrip() + ",\nfact AS (" + _fact(False) + ")\n"
    sql = {
        "silver_typed": _TO_TYPED + f"SELECT {_TYPED_TEXT} FROM typed",
        "silver_dedup": _TO_TYPED + f"SELECT DISTINCT {_TYPED_TEXT} FROM typed",
        "silver_fill_nulls": _TO_TYPED + f"SELECT {_TYPED_TEXT} FROM (SELECT {_FILLED} FROM typed)",
        "silver_year": _TO_TYPED
        + """SELECT CAST(year("Timestamp do Registro") AS INTEGER) AS ano, count(*) AS registros
FROM typed GROUP BY 1""",
        "silver_full": _TO_SILVER + f"SELECT {_TYPED_TEXT} FROM silver",
        "gold_full": _TO_GOLD + f"SELECT {_GOLD_TEXT} FROM gold",
        "gold_full_name": _TO_GOLD + "SELECT nome, sobrenome, nome_completo FROM gold",
        "gold_email_domain": _TO_GOLD + "SELECT email, dominio_email FROM gold",
        "gold_net_value": _TO_GOLD
        + f"""SELECT valor_da_compra, desconto_oferecido, valor_com_desconto, valor_exato, valor_liquido_exato
FROM (SELECT {_GOLD_TEXT} FROM gold)""",
        "gold_daypart_events": f"""SELECT {_day_part("ts")} AS turno, CAST(hour(ts) AS INTEGER) AS hora,
count(*) AS registros FROM events GROUP BY 1, 2""",
        "daypart_year_revenue": _TO_GOLD + _BY_DAYPART_AND_YEAR,
        "source_lineage": _with(_RAW)
        + f"""SELECT {file} || '.csv' AS arquivo, {file} AS sem_extensao, {stamp} AS carimbo,
{stamp} || '_' || {file} AS origem FROM raw""",
        "bronze_csv": _with(_RAW) + f"SELECT {raw_columns} FROM raw",
        "bronze_admitted": _with(_RAW) + f"SELECT {raw_columns} FROM raw",
        "bronze_rejects": """SELECT concat_ws(',', l_orderkey, l_linenumber, 'x', 'x', 'x', 'x', 'x', 'x', 'x', 'x', 'x',
CASE WHEN l_orderkey % 5 = 0 THEN replace(price, '.', ',') || ',y' ELSE price END) AS linha
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM lineitem)
WHERE l_orderkey % 5 < 2""",
        "partition_roundtrip": _TO_GOLD + f"SELECT {_GOLD_TEXT} FROM gold WHERE ano = 1996",
        "warehouse_load": _TO_GOLD + _BY_SOURCE,
        "warehouse_append": _TO_GOLD
        + """SELECT arquivo_de_origem, 2 * count(arquivo_de_origem) AS registros
FROM gold GROUP BY arquivo_de_origem""",
        "star_rebuild": _TO_DIMS
        + f"""{dim_counts}
UNION ALL SELECT '{STAGING_TABLE}', count(*) FROM gold
UNION ALL SELECT '{FACT_TABLE}', count(*) FROM gold""",
        "star_dropped": _TO_DIMS
        + f"""SELECT *, 'antes' AS momento FROM ({dim_counts}
UNION ALL SELECT '{STAGING_TABLE}', count(*) FROM gold
UNION ALL SELECT '{FACT_TABLE}', count(*) FROM gold)
UNION ALL SELECT '{STAGING_TABLE}', 0, 'depois'""",
        "star_contents": _TO_GOLD
        + f"SELECT arquivo_de_origem, ano, {', '.join(c for d in DIMENSIONS for c in d.key)} FROM gold",
        "batch_checks": _TO_DIMS
        + f"""SELECT *, valor AS esperado, true AS confere FROM (
SELECT 'vendas' AS verificacao, count(*) AS valor FROM gold
UNION ALL SELECT 'chave {FACT_TABLE}', count(*) FROM gold
UNION ALL SELECT 'chave ' || tabela, registros FROM ({dim_counts})
{' '.join(f"UNION ALL SELECT 'referencia {d.id}', 0" for d in DIMENSIONS)})""",
        "batch_run": _TO_GOLD + _BY_DAYPART_AND_YEAR,
        "stream_run": _TO_GOLD + _BY_DAYPART_AND_YEAR,
        "batch_increments": _TO_GOLD
        + """SELECT 0 AS corrida, r.n AS linhas, false AS recusados, f.n AS registros FROM raws AS r, per_file AS f
UNION ALL SELECT 1, r.n, true, 2 * f.n FROM raws AS r, per_file AS f
UNION ALL SELECT 2, 0, false, 2 * f.n FROM raws AS r, per_file AS f""".replace(
            "raws", "(SELECT count(*) AS n FROM raw)"
        ).replace("per_file", "(SELECT count(*) AS n FROM gold)"),
        "batch_reconciled": _TO_GOLD
        + """SELECT r.n AS bronze, g.n AS silver, g.n AS gold, g.n AS fato, r.n - g.n AS duplicados, true AS confere
FROM (SELECT count(*) AS n FROM raw) AS r, (SELECT count(*) AS n FROM gold) AS g""",
        "star_keys_kept": _TO_GOLD
        + """SELECT row_number() OVER (ORDER BY CAST(telefone AS BIGINT) % 2, nome_completo NULLS FIRST, email NULLS FIRST,
  dominio_email NULLS FIRST, telefone NULLS FIRST) - 1 AS cliente_id, *
FROM (SELECT DISTINCT nome_completo, email, dominio_email, telefone FROM gold)""",
        "fact_hashed": _TO_GOLD
        + f"SELECT arquivo_de_origem, ano, {', '.join(c for d in DIMENSIONS for c in d.key)} FROM gold",
        "silver_across_files": _TO_SILVER
        + f"""SELECT {_TYPED_TEXT} FROM (SELECT * REPLACE ('novo_a_' || "Arquivo de Origem" AS "Arquivo de Origem") FROM silver
WHERE CAST("Telefone" AS BIGINT) % 3 <> 0)""",
        "cast_losses": _with(_RAW)
        + """SELECT "Arquivo de Origem" AS arquivo_de_origem, coluna, perdidos FROM (
UNPIVOT (SELECT "Arquivo de Origem",
    count(*) FILTER ("Timestamp do Registro" IS NOT NULL
      AND try_strptime("Timestamp do Registro", '%Y-%m-%d %H:%M:%S') IS NULL) AS "Timestamp do Registro",
    count(*) FILTER ("Valor da Compra" IS NOT NULL
      AND TRY_CAST(replace("Valor da Compra", ',', '.') AS FLOAT) IS NULL) AS "Valor da Compra",
    count(*) FILTER ("Desconto Oferecido" IS NOT NULL
      AND TRY_CAST(replace("Desconto Oferecido", '%', '') AS FLOAT) IS NULL) AS "Desconto Oferecido",
    count(*) FILTER (NOT regexp_matches("Valor da Compra", '^[+-]?[0-9]+([.,][0-9]{0,2}0*)?$')) AS "Valor Exato"
  FROM raw GROUP BY 1)
ON "Timestamp do Registro", "Valor da Compra", "Desconto Oferecido", "Valor Exato" INTO NAME coluna VALUE perdidos)""",
        "fact_sales": fact_with + "SELECT * FROM fact",
        "fact_sales_legacy": _TO_DIMS + _fact(True),
        "fact_year_text": _TO_GOLD
        + "SELECT CAST(ano AS VARCHAR) AS ano, count(ano) AS registros FROM gold GROUP BY 1",
        "fact_key": _TO_GOLD
        + """SELECT count(*) AS registros, count(*) AS distintos, 0 AS primeiro,
count(*) - 1 AS ultimo FROM gold""",
        "order_key": """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pedido_id,
o_orderdate, o_orderkey FROM orders""",
        "check_rows": _TO_GOLD + "SELECT count(*) AS registros FROM gold",
        "check_group_count": _TO_GOLD
        + """SELECT dominio_email, count(dominio_email) AS registros
FROM gold GROUP BY dominio_email""",
        "check_sources": _TO_GOLD + _BY_SOURCE,
        "check_distinct": _TO_GOLD + "SELECT count(DISTINCT email) AS distintos FROM gold",
        "check_pk": """
SELECT count(*) AS registros, count(DISTINCT o_orderkey) AS distintos,
       count(*) = count(DISTINCT o_orderkey) AS unica, 'orders' AS tabela FROM orders
UNION ALL
SELECT count(*), count(DISTINCT (l_orderkey, l_linenumber)),
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)), 'lineitem' FROM lineitem""",
        "check_pk_cliente": _TO_DIMS
        + """SELECT count(*) AS registros, count(DISTINCT cliente_id) AS distintos,
count(*) = count(DISTINCT cliente_id) AS unica FROM dim_cliente""",
        "check_fk": fact_with
        + " UNION ALL ".join(_orphans("fact", d.id, d.table, d.id) for d in DIMENSIONS),
        "check_fk_orders": " UNION ALL ".join(
            [
                _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
                _orphans("orders", "o_custkey", "customer", "c_custkey"),
                _orphans("events", "user_id", "customer", "c_custkey"),
            ]
        ),
        "profile_nulls": _with(_RAW)
        + _per_column("raw", 'count(*) - count("{c}")', bronze, "nulos"),
        "profile_schema_counts": _TO_SILVER
        + f"SELECT coluna, CASE coluna {type_of} END AS tipo, preenchidos FROM ("
        + _per_column("silver", 'count("{c}")', list(spark_types), "preenchidos")
        + ")",
        "duplicates_report": _with(_RAW)
        + f"""SELECT "Arquivo de Origem" AS arquivo_de_origem, CAST(sum(vezes) AS BIGINT) AS total,
CAST(sum(vezes - 1) AS BIGINT) AS duplicados, count(*) AS unicos
FROM (SELECT {all_columns}, count(*) AS vezes FROM raw GROUP BY ALL) GROUP BY 1""",
        "duplicate_rows": _with(_RAW)
        + f"SELECT {all_columns}, count(*) AS vezes FROM raw GROUP BY ALL HAVING count(*) > 1",
        "reconcile_layers": fact_with
        + """SELECT b.arquivo_de_origem, b.n AS bronze, s.n AS silver, g.n AS gold, f.n AS fato,
b.n - s.n AS duplicados, s.n = g.n AND g.n = f.n AND s.n <= b.n AS confere
FROM (SELECT "Arquivo de Origem" AS arquivo_de_origem, count(*) AS n FROM raw GROUP BY 1) AS b
JOIN (SELECT "Arquivo de Origem" AS arquivo_de_origem, count(*) AS n FROM silver GROUP BY 1) AS s
  USING (arquivo_de_origem)
JOIN (SELECT arquivo_de_origem, count(*) AS n FROM gold GROUP BY 1) AS g USING (arquivo_de_origem)
JOIN (SELECT arquivo_de_origem, count(*) AS n FROM fact GROUP BY 1) AS f USING (arquivo_de_origem)""",
    }
    first = ", ".join(f"{c} NULLS FIRST" for c in GOLD.names)
    sql["sample_rows"] = _TO_GOLD + f"SELECT {_GOLD_TEXT} FROM (SELECT * FROM gold ORDER BY {first} LIMIT 5)"
    sql["sample_size"] = _TO_GOLD + "SELECT count(*) AS registros FROM (SELECT * FROM gold LIMIT 5)"
    for d in DIMENSIONS:
        sql[d.table] = _TO_DIMS + f"SELECT * FROM {d.table}"
    return sql


ORACLES = _oracles()
