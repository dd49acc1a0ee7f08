"""DataFrame operators; importing the package fills the registries."""

from chatloom.operators import block_template, transforms  # noqa: F401
