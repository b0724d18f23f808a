"""Table layouts of every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Headers of the landing files, in file order.
BRONZE_COLUMNS = [
    "Timestamp do Registro",
    "Nome",
    "Sobrenome",
    "Email",
    "Telefone",
    "Produto Adquirido",
    "Valor da Compra",
    "Canal",
    "Plataforma de Interação",
    "Campanha de Marketing",
    "Vendedor",
    "Desconto Oferecido",
    "Código de Desconto Usado",
]

# Lineage and partition columns of the silver and gold layers.
SILVER_SOURCE, SILVER_YEAR = "Arquivo de Origem", "Ano"
SILVER_EXACT = "Valor Exato"
SOURCE, YEAR = "arquivo_de_origem", "ano"
# Partition of the layers and of the staging table: number of the load that brought the rows.
LOAD = "carga"

# Money as the text says it, and its product with a discount of up to six places.
MONEY, NET_MONEY = T.DecimalType(18, 2), T.DecimalType(28, 8)

# Silver types that differ from string.
_SILVER_TYPES = {
    "Timestamp do Registro": T.TimestampNTZType(),
    "Valor da Compra": T.FloatType(),
    "Desconto Oferecido": T.DoubleType(),
}

BRONZE = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS])

SILVER = T.StructType(
    [T.StructField(c, _SILVER_TYPES.get(c, T.StringType())) for c in BRONZE_COLUMNS]
    + [
        T.StructField(SILVER_EXACT, MONEY),
        T.StructField(SILVER_SOURCE, T.StringType()),
        T.StructField(SILVER_YEAR, T.IntegerType()),
    ]
)

# Gold and warehouse staging columns, in table order; the exact values stand before the partition columns.
GOLD = T.StructType(
    [
        T.StructField("timestamp_do_registro", T.TimestampNTZType()),
        T.StructField("turno_compra", T.StringType()),
        T.StructField("nome", T.StringType()),
        T.StructField("sobrenome", T.StringType()),
        T.StructField("nome_completo", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("dominio_email", T.StringType()),
        T.StructField("telefone", T.StringType()),
        T.StructField("produto_adquirido", T.StringType()),
        T.StructField("valor_da_compra", T.FloatType()),
        T.StructField("desconto_oferecido", T.DoubleType()),
        T.StructField("valor_com_desconto", T.DoubleType()),
        T.StructField("canal", T.StringType()),
        T.StructField("plataforma_de_interacao", T.StringType()),
        T.StructField("campanha_de_marketing", T.StringType()),
        T.StructField("vendedor", T.StringType()),
        T.StructField("codigo_de_desconto_usado", T.StringType()),
        T.StructField("valor_exato", MONEY),
        T.StructField("valor_liquido_exato", NET_MONEY),
        T.StructField(SOURCE, T.StringType()),
        T.StructField(YEAR, T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Dimension:
    """One dimension: table name, surrogate key and natural key."""

    table: str
    id: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.id, T.LongType())] + [GOLD[c] for c in self.key]
        )


# Dimension tables, ordered from few expected rows to many. The
# fact looks them up in this order, so that a lookup too big to broadcast
# shuffles rows whose other natural keys have already become ids.
DIMENSIONS = [
    Dimension("dim_desconto", "desconto_id", ("codigo_de_desconto_usado", "desconto_oferecido")),
    Dimension("dim_canal", "canal_id", ("canal",)),
    Dimension("dim_plataforma", "plataforma_id", ("plataforma_de_interacao",)),
    Dimension("dim_campanha", "campanha_id", ("campanha_de_marketing",)),
    Dimension("dim_vendedor", "vendedor_id", ("vendedor",)),
    Dimension("dim_produto", "produto_id", ("produto_adquirido",)),
    Dimension("dim_cliente", "cliente_id", ("nome_completo", "email", "dominio_email", "telefone")),
]

# The staging table, a view over the loads that count, and what lies behind it.
STAGING_TABLE = "registros_vendas"
LOADS_TABLE = "registros_vendas_cargas"
SOURCES_TABLE = "registros_vendas_fontes"
FACT_TABLE = "fato_vendas"
# The star's versions, their number in every table behind a view, and endings of those tables' names.
STAR_TABLE = "estrela"
VERSION_COLUMN = "versao"
VERSIONS, KEYS = "_versoes", "_chaves"

# Fact columns, in table order.
FACT = T.StructType(
    [
        T.StructField("venda_id", T.LongType()),
        T.StructField("timestamp_do_registro", T.TimestampNTZType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("cliente_id", T.LongType()),
        T.StructField("produto_id", T.LongType()),
        T.StructField("canal_id", T.LongType()),
        T.StructField("plataforma_id", T.LongType()),
        T.StructField("campanha_id", T.LongType()),
        T.StructField("vendedor_id", T.LongType()),
        T.StructField("desconto_id", T.LongType()),
        T.StructField("valor_da_compra", T.DoubleType()),
        T.StructField("turno_compra", T.StringType()),
        T.StructField("valor_com_desconto", T.DoubleType()),
        T.StructField("valor_exato", MONEY),
        T.StructField("valor_liquido_exato", NET_MONEY),
        T.StructField("arquivo_de_origem", T.StringType()),
    ]
)
