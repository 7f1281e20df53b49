"""demandspark: Spark-native demand forecasting features, models and checks.

Every operator is a DataFrame/SQL expression or a Spark ML stage; nothing is
collected to the driver and no Python UDF runs in the data path.
"""

from demandspark.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
