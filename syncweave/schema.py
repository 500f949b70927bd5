"""The payload schema, its logical types, and the projection that conforms any row set to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncweave.functions import eras

KEY = ("SellBranch", "SellID", "RowNo")

#: Payload fields in fingerprint order with their source types.
FIELDS = (
    ("CrTime", "datetime"), ("SellID", "int"), ("SellBranch", "int"), ("Product", "varchar"), ("MIN PRICE", "money"), ("SRP", "money"),
    ("NUMBER", "int"), ("PBV", "numeric"), ("PAV", "numeric"), ("TOTAL PBV", "money"), ("VAT", "float"), ("TOTAL PAV", "numeric"),
    ("COGS / UNIT", "money"), ("GP / UNIT", "numeric"), ("COGS", "money"), ("GP", "money"), ("GP %", "float"), ("VAT %", "money"),
    ("VATValue", "money"), ("TotalPrice", "money"), ("VAT ALLOCATE", "float"), ("Product Name", "varchar"), ("CategoryID", "int"),
    ("CategoryName", "varchar"), ("SubCat", "varchar"), ("Brand", "varchar"), ("Model", "varchar"), ("ProductType", "varchar"),
    ("Customer Code", "varchar"), ("Customer Name", "varchar"), ("Customer Type", "varchar"), ("CustomerTypeID", "int"),
    ("Branch Name", "varchar"), ("STATUS", "int"), ("UTime", "datetime"), ("SerialShouldSalesFirst", "varchar"), ("is_return", "int"),
    ("is_tradein", "int"), ("mem_code", "varchar"), ("Comment", "varchar"), ("is_unbrick", "int"),
)
#: Decimals shown for each numeric source type.
PRECISION = {"int": 0, "money": 2, "numeric": 4, "float": 2}
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Field:
    name: str
    source: str

    @property
    def logical(self) -> str:
        return {"datetime": "datetime", "varchar": "text"}.get(self.source, "number")

    @property
    def spark_type(self) -> T.DataType:
        if self.source in ("datetime", "int"):
            return T.LongType()
        return T.StringType() if self.source == "varchar" else T.DoubleType()

    def struct(self) -> T.StructField:
        """The field with its target definition as metadata."""
        meta = {"type": self.logical}
        if self.logical == "number":
            meta |= {"style": "plain", "precision": PRECISION[self.source]}
        elif self.logical == "datetime":
            meta |= {"style": "yyyy-MM-dd HH:mm"}
        return T.StructField(self.name, self.spark_type, True, meta)

    def value(self, raw: Column, kind: str = "string") -> Column:
        """The payload value of a raw source column of a type; what can't be read is null."""
        if self.logical == "datetime":
            return eras.be_to_epoch_ms(raw.cast("string"))
        if self.source != "int":
            return raw.try_cast(self.spark_type.simpleString())
        # integers may arrive as text with decimals ('3.00'); a double would round those above 2**53
        return raw.try_cast("bigint") if kind in _INTEGERS else raw.try_cast("decimal(38,6)").try_cast("bigint")


PAYLOAD = tuple(Field(n, s) for n, s in FIELDS)


def payload_schema(fields: tuple[Field, ...] = PAYLOAD) -> T.StructType:
    return T.StructType([f.struct() for f in fields])


def transform(df: DataFrame, *keep: str, fields: tuple[Field, ...] = PAYLOAD) -> DataFrame:
    """``keep`` columns and a struct ``payload`` of all declared fields: absent columns are null, others go."""
    have = dict(df.dtypes)
    values = [(f.value(F.col(f"`{f.name}`"), have[f.name]) if f.name in have else F.lit(None).cast(f.spark_type)).alias(f.name) for f in fields]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.struct(*values).alias("payload"))


def schema_drift(df: DataFrame, declared: tuple[str, ...] = (*[f.name for f in PAYLOAD], "RowNo")) -> DataFrame:
    """(column_name, drift): declared columns that are missing, and actual ones that are not declared."""
    actual, wanted = set(df.columns), set(declared)
    rows = [(c, "missing") for c in declared if c not in actual] + [(c, "extra") for c in df.columns if c not in wanted]
    return df.sparkSession.createDataFrame(rows, "column_name string, drift string")
