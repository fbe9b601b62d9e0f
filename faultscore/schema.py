"""Task description: which columns are ids, features, target and leaks."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TaskSpec:
    """Column roles of one labelled table.

    ``numeric`` and ``categorical`` keep their order: the feature vector is
    the numeric block followed by the one-hot block, as in the reference.
    """

    id_column: str
    extra_id_columns: tuple[str, ...]
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    target: str
    leak_columns: tuple[str, ...]
    category_domain: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def id_columns(self) -> tuple[str, ...]:
        return (self.id_column, *self.extra_id_columns)

    @property
    def features(self) -> tuple[str, ...]:
        """Feature columns in the reference order: categorical first."""
        return (*self.categorical, *self.numeric)

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.id_columns, *self.features, self.target, *self.leak_columns)


# The machine table's column roles, category domain and error
# texts must equal the reference's contract.
MACHINE_TASK = TaskSpec(
    id_column="udi",
    extra_id_columns=("product_id",),
    categorical=("type",),
    numeric=(
        "air_temperature",
        "process_temperature",
        "rotational_speed",
        "torque",
        "tool_wear",
    ),
    target="machine_failure",
    leak_columns=("twf", "hdf", "pwf", "osf", "rnf"),
    category_domain={"type": ("L", "M", "H")},
)

# The column names of the original machine CSV file.
MACHINE_CSV_TASK = TaskSpec(
    id_column="UDI",
    extra_id_columns=("Product ID",),
    categorical=("Type",),
    numeric=("Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]", "Torque [Nm]", "Tool wear [min]"),
    target="Machine failure",
    leak_columns=("TWF", "HDF", "PWF", "OSF", "RNF"),
    category_domain={"Type": ("L", "M", "H")},
)

# labels joined to documents: toxic is the target, quality its leak column.
DOCUMENT_TASK = TaskSpec(
    id_column="doc_id",
    extra_id_columns=(),
    categorical=("lang", "source"),
    numeric=("n_chars",),
    target="toxic",
    leak_columns=("quality",),
    category_domain={},
)

# orders: a three-value status as the category, price as the numeric feature.
ORDER_TASK = TaskSpec(
    id_column="o_orderkey",
    extra_id_columns=("o_custkey",),
    categorical=("o_orderstatus",),
    numeric=("o_totalprice",),
    target="urgent",
    leak_columns=("o_orderpriority",),
    category_domain={"o_orderstatus": ("F", "O", "P")},
)

# orders by customer too: as many categories as there are customers.
CUSTOMER_TASK = TaskSpec(
    id_column="o_orderkey",
    extra_id_columns=(),
    categorical=("o_orderstatus", "o_custkey"),
    numeric=("o_totalprice",),
    target="urgent",
    leak_columns=("o_orderpriority",),
    category_domain={},
)
