"""Data contracts: the declared shape of a table and the rules the loads apply.

A contract lists fields in order (type, required, unique, pattern, enum, precision, scale), the primary
key, the table type (SCD1 / SCD2 / FACT) and the dimension dependencies whose surrogate keys a table
carries. Contracts are small driver-side objects; they only decide which column expressions are built.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# System columns added by the loads (fixed names the layers agree on).
EXTRACT_TAG = "extract_timestamp"
INGEST_TS = "dbx_extract_timestamp"
START_DATE = "effective_start_date"
END_DATE = "effective_end_date"
CREATE_DATE = "create_date"
UPDATE_DATE = "update_date"
IS_ACTIVE = "is_active"
ROW_HASH = "_hash"
SYSTEM_COLUMNS = (EXTRACT_TAG, INGEST_TS, START_DATE, END_DATE)


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = False
    unique: bool = False
    pattern: str | None = None
    enum: tuple[str, ...] | None = None
    precision: int | None = None
    scale: int | None = None
    surrogate_key: bool = False

    def spark_type(self) -> T.DataType:
        return spark_type_of(self.type, self.precision, self.scale)


@dataclass(frozen=True)
class Dependency:
    """A dimension this table looks up: its table, surrogate key and natural keys."""
    table: str
    surrogate_key: str
    natural_keys: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    table_type: str = "UNKNOWN"
    dependencies: tuple[Dependency, ...] = ()
    description: str = ""
    business_keys: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        """Business keys when declared (older contracts), else the primary key."""
        return self.business_keys or self.primary_key

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def surrogate_keys(self) -> list[str]:
        """All surrogate-key columns, in contract order: fields flagged as such (older contracts), and names
        that end in ``_sk``."""
        return [f.name for f in self.fields if f.surrogate_key or f.name.lower().endswith("_sk")]

    def own_surrogate_keys(self) -> list[str]:
        """Surrogate keys this table mints itself (dependency keys removed)."""
        dep = {d.surrogate_key for d in self.dependencies}
        return [c for c in self.surrogate_keys() if c not in dep]

    def to_struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type(), not f.required) for f in self.fields])

    def with_fields(self, *extra: Field) -> "Contract":
        return Contract(self.name, self.fields + tuple(extra), self.primary_key, self.table_type,
                        self.dependencies, self.description, self.business_keys)


def spark_type_of(type_name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Contract type name -> Spark type (unknown names are strings)."""
    t = (type_name or "string").lower()
    if t in ("int", "integer"):
        return T.IntegerType()
    if t in ("long", "bigint"):
        return T.LongType()
    if t == "short":
        return T.ShortType()
    if t == "byte":
        return T.ByteType()
    if t == "float":
        return T.FloatType()
    if t == "double":
        return T.DoubleType()
    if t == "decimal":
        # Fixed value: decimal default precision and scale when the contract gives none.
        return T.DecimalType(precision or 30, scale if scale is not None else 10)
    if t in ("boolean", "bool"):
        return T.BooleanType()
    if t == "date":
        return T.DateType()
    if t == "timestamp":
        return T.TimestampType()
    return T.StringType()


_TYPE_WORDS = ("SCD1", "SCD2", "FACT")


def table_type_from_description(description: str, explicit: str | None = None) -> str:
    """Explicit type wins; otherwise the first of SCD1, SCD2, FACT found as a whole word."""
    if explicit:
        return explicit.upper()
    words = set(re.findall(r"[A-Z0-9]+", (description or "").upper()))
    for w in _TYPE_WORDS:
        if w in words:
            return w
    return "UNKNOWN"


def contract_from_dict(doc: dict, model: str | None = None) -> Contract:
    """Build a contract from a parsed data-contract document (``models.<name>.fields`` layout)."""
    models = doc.get("models") or {}
    if not models:
        raise ValueError("contract has no models")
    name = model or next(iter(models))
    m = models[name]
    fields = []
    for fname, meta in (m.get("fields") or {}).items():
        meta = meta or {}
        enum = meta.get("enum")
        fields.append(Field(
            name=fname, type=str(meta.get("type", "string")), required=bool(meta.get("required", False)),
            unique=bool(meta.get("unique", False)), pattern=meta.get("pattern"),
            enum=tuple(enum) if enum else None, precision=meta.get("precision"), scale=meta.get("scale"),
            surrogate_key=bool(meta.get("surrogateKey", False)),
        ))
    deps = tuple(
        Dependency(d["table"], d["surrogateKey"], tuple(d.get("naturalKeys") or ()))
        for d in (m.get("dependencies") or [])
    )
    description = (doc.get("info") or {}).get("description", "")
    return Contract(name=name, fields=tuple(fields), primary_key=tuple(m.get("primaryKey") or ()),
                    table_type=table_type_from_description(description, m.get("tableType")),
                    dependencies=deps, description=description,
                    business_keys=tuple(m.get("businessKeys") or ()))


def load_contract(path: str, model: str | None = None) -> Contract:
    """Read a YAML contract file; failures raise instead of returning a placeholder."""
    import yaml

    with open(path) as fh:
        doc = yaml.safe_load(fh)
    if not isinstance(doc, dict):
        raise ValueError(f"not a contract document: {path}")
    return contract_from_dict(doc, model)


def evolution_allowed(source_columns, target_columns, contract_columns) -> bool:
    """Gate: every column new in the source (not yet in the target) must be declared by the contract."""
    return set(source_columns) - set(target_columns) <= set(contract_columns)


# ---------------------------------------------------------------------------------------------------
# The consumer star schema. Field names and order, validation patterns, the product category enum.
# All business keys are long: they pass 2**31 at large scale and a cast must not drop them.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^[0-9+\- ]{7,15}$"
_SYS = (Field(EXTRACT_TAG, "string", required=True), Field(INGEST_TS, "timestamp", required=True))

SILVER_CUSTOMERS = Contract(
    "silver.consumer.dim_customers",
    (Field("customer_id", "long", required=True, unique=True), Field("name", "string", required=True),
     Field("email", "string", required=True, pattern=EMAIL_PATTERN),
     Field("phone", "string", pattern=PHONE_PATTERN), Field("address", "string"),
     Field("loyalty_points", "integer")) + _SYS,
    primary_key=("customer_id",), table_type="UNKNOWN")

SILVER_SUPPLIERS = Contract(
    "silver.consumer.dim_suppliers",
    (Field("supplier_id", "long", required=True, unique=True), Field("name", "string", required=True),
     Field("phone", "string", pattern=PHONE_PATTERN), Field("address", "string")) + _SYS,
    primary_key=("supplier_id",))


def silver_products(categories: tuple[str, ...]) -> Contract:
    return Contract(
        "silver.consumer.dim_products",
        (Field("product_id", "long", required=True, unique=True), Field("product_name", "string", required=True),
         Field("category", "string", required=True, enum=categories), Field("price", "decimal", required=True),
         Field("supplier_id", "string", required=True)) + _SYS,
        primary_key=("product_id",))


SILVER_ORDERS = Contract(
    "silver.consumer.fact_orders",
    (Field("order_id", "long", required=True), Field("customer_id", "long", required=True),
     Field("product_id", "long", required=True), Field("quantity", "integer", required=True),
     Field("total_price", "decimal", required=True, precision=12, scale=2),
     Field("order_date", "date", required=True)) + _SYS,
    primary_key=("order_id",))

GOLD_CUSTOMERS = Contract(
    "gold.consumer.dim_customers",
    SILVER_CUSTOMERS.fields + (Field("customer_id_sk", "long", required=True), Field(START_DATE, "date"),
                               Field(END_DATE, "date")),
    primary_key=("customer_id",), table_type="SCD2")

GOLD_SUPPLIERS = Contract(
    "gold.consumer.dim_suppliers",
    SILVER_SUPPLIERS.fields + (Field("supplier_id_sk", "long", required=True), Field(CREATE_DATE, "date"),
                               Field(UPDATE_DATE, "date")),
    primary_key=("supplier_id",), table_type="SCD1")

GOLD_PRODUCTS_DEPS = (Dependency("gold.consumer.dim_suppliers", "supplier_id_sk", ("supplier_id",)),)
GOLD_ORDERS_DEPS = (Dependency("gold.consumer.dim_customers", "customer_id_sk", ("customer_id",)),
                    Dependency("gold.consumer.dim_products", "product_id_sk", ("product_id",)))


def gold_products(categories: tuple[str, ...]) -> Contract:
    base = silver_products(categories)
    return Contract("gold.consumer.dim_products",
                    base.fields + (Field("product_id_sk", "long", required=True), Field("supplier_id_sk", "long"),
                                   Field(START_DATE, "date"), Field(END_DATE, "date")),
                    primary_key=("product_id",), table_type="SCD2", dependencies=GOLD_PRODUCTS_DEPS)


GOLD_ORDERS = Contract(
    "gold.consumer.fact_orders",
    (Field("order_id", "long", required=True), Field("customer_id_sk", "long", required=True),
     Field("product_id_sk", "long", required=True), Field("quantity", "integer", required=True),
     Field("total_price", "decimal", required=True, precision=12, scale=2), Field("order_date", "date", required=True))
    + _SYS + (Field(CREATE_DATE, "date"), Field(UPDATE_DATE, "date")),
    primary_key=("order_id",), table_type="FACT", dependencies=GOLD_ORDERS_DEPS)
