"""hourcast: hourly panel forecasting analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) parameterised by a :class:`~hourcast.spec.PanelSpec`.
"""

from hourcast.spec import MEASURES, PanelSpec

__all__ = ["MEASURES", "PanelSpec"]
