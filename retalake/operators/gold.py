"""Silver to gold: plain names, derived columns, closed projection. No shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalake.functions.columns import day_part, email_domain, exact_net, full_name, net_value
from retalake.functions.names import plain_columns
from retalake.schemas import GOLD, YEAR


def to_gold(
    silver: DataFrame, trim_parts: bool = True, null_as_night: bool = False
) -> DataFrame:
    """Enriched sales in table order."""
    moment = F.col("timestamp_do_registro")
    derived = {
        "nome_completo": full_name(F.col("nome"), F.col("sobrenome"), trim_parts),
        "dominio_email": email_domain(F.col("email")),
        "turno_compra": day_part(moment, null_as_night),
        "valor_com_desconto": net_value(F.col("valor_da_compra"), F.col("desconto_oferecido")),
        "valor_liquido_exato": exact_net(F.col("valor_exato"), F.col("desconto_oferecido")),
        YEAR: F.year(moment),
    }
    return plain_columns(silver).withColumns(derived).select(*GOLD.names)
