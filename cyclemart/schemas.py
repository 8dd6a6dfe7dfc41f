"""Warehouse table schemas, natural keys and storage partitions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
DAY, TEXT, LONG, INT = T.DateType(), T.StringType(), T.LongType(), T.IntegerType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRODUCT_LIST = T.ArrayType(_struct(nome=TEXT, valor=MONEY, refforn=TEXT, complemento=TEXT))
SELLER_LIST = T.ArrayType(_struct(nome=TEXT, valor=MONEY))
FACT_MEASURES = (
    "valor_meta_diaria", "valor_meta_mensal", "valor_realizado", "valor_devolucao",
    "valor_cancelado", "valor_comissao", "valor_desconto", "qtd_transacoes",
)


@dataclass(frozen=True)
class Table:
    """``defaults`` fill columns that older files lack; ``required`` columns, and the keys, are never written as null."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition: str | None = None
    sort: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    required: tuple[str, ...] = ()


TABLES = {
    t.name: t
    for t in (
        Table(
            "dim_tempo",
            _struct(id_tempo=DAY, ano=INT, mes=INT, dia=INT, trimestre=INT, nome_mes=TEXT, dia_da_semana=TEXT),
            ("id_tempo",),
        ),
        Table(
            "dim_vendedor",
            _struct(id_vendedor=LONG, nome_comercial=TEXT, nivel_acesso=TEXT, id_gestor=LONG, equipe=TEXT),
            ("id_vendedor",),
        ),
        Table("dim_statuspedido", _struct(id_status=INT, descricao=TEXT), ("id_status",)),
        Table("dim_empresa", _struct(id_empresa=LONG, nome=TEXT), ("id_empresa",)),
        Table("dim_parceiro", _struct(id_parceiro=LONG, nome_parceiro=TEXT), ("id_parceiro",)),
        Table("dim_marca", _struct(id_marca=LONG, nome_marca=TEXT), ("id_marca",)),
        Table(
            "dim_produto", _struct(id_produto=LONG, nome_produto=TEXT, refforn=TEXT, complemento=TEXT), ("id_produto",)
        ),
        Table("dim_tempo_ref", _struct(dtref=DAY, dtinic=DAY, dtfin=DAY, label=TEXT), ("dtref",)),
        Table(
            "fato_vendasdiarias",
            _struct(id_tempo=DAY, id_vendedor=LONG, id_empresa=LONG, valor_meta_diaria=MONEY, valor_meta_mensal=MONEY,
                    valor_realizado=MONEY, valor_devolucao=MONEY, valor_cancelado=MONEY, valor_comissao=MONEY,
                    valor_desconto=MONEY, qtd_transacoes=LONG, ano_mes=TEXT),
            ("id_tempo", "id_vendedor", "id_empresa"),
            partition="ano_mes",
            sort=("id_empresa", "id_vendedor", "id_tempo"),
            defaults={c: 0 for c in FACT_MEASURES},
            required=FACT_MEASURES,
        ),
        Table(
            "cubo_kpi",
            _struct(id_empresa=LONG, id_vendedor=LONG, valor_realizado=T.DecimalType(18, 2), valor_devolucao=T.DecimalType(18, 2),
                    valor_cancelado=T.DecimalType(18, 2), valor_desconto=T.DecimalType(18, 2), qtd_transacoes=LONG,
                    valor_meta_mensal=MONEY, movimento=T.BooleanType(), linhas=LONG, dias_venda=LONG, ultimo_dia=DAY,
                    ultima_comissao=MONEY, ultimo_realizado=MONEY, dtref=DAY),
            ("dtref", "id_empresa", "id_vendedor"),
            partition="dtref",
            sort=("id_empresa", "id_vendedor"),
        ),
        Table(
            "fato_rankings",
            _struct(id_vendedor=LONG, id_empresa=LONG, tipo=TEXT, id_item=LONG, valor=MONEY, posicao=INT,
                    label_item=TEXT, nivel=INT, dtref=DAY),
            ("dtref", "nivel", "id_vendedor", "id_empresa", "tipo", "posicao"),
            required=("id_item", "valor"),
            partition="dtref",
            sort=("nivel", "id_empresa", "id_vendedor"),
        ),
        Table(
            "listas_empresa",
            _struct(id_empresa=LONG, tipo=TEXT, id_item=LONG, label_item=TEXT, total=T.DecimalType(38, 4), posicao=INT,
                    corte=T.DecimalType(38, 4), cheia=T.BooleanType(), dtref=DAY),
            ("dtref", "id_empresa", "tipo", "posicao"),
            partition="dtref",
            sort=("id_empresa", "tipo", "posicao"),
        ),
        Table(
            "fato_cliente_perfil",
            _struct(id_cliente=LONG, id_empresa=LONG, id_vendedor=LONG, top_produtos=PRODUCT_LIST,
                    top_vendedores=SELLER_LIST, tempo_medio_compra=MONEY, nivel=INT, dtref=DAY),
            ("dtref", "nivel", "id_cliente", "id_empresa", "id_vendedor"),
            partition="dtref",
            sort=("nivel", "id_empresa", "id_vendedor", "id_cliente"),
            defaults={"id_vendedor": 0},
        ),
        Table(
            "fato_marca_perfil",
            _struct(id_marca=LONG, id_empresa=LONG, id_vendedor=LONG, top_produtos=PRODUCT_LIST, nivel=INT, dtref=DAY),
            ("dtref", "nivel", "id_marca", "id_empresa", "id_vendedor"),
            partition="dtref",
            sort=("nivel", "id_empresa", "id_vendedor", "id_marca"),
            defaults={"id_vendedor": 0},
        ),
        Table(
            "usuarios_acesso",
            _struct(username=TEXT, role=TEXT, seller_id=INT, managed_sellers=T.ArrayType(INT),
                    is_active=T.BooleanType()),
            ("username",),
        ),
    )
}
