"""queryscope: on-site search analytics as Spark DataFrame operators.

Every public operator is a pure ``DataFrame -> DataFrame`` function (or a
dict of DataFrames for report bundles).  Nothing is collected to the driver;
all work is planned by Catalyst and executed on the cluster.
"""

__version__ = "0.1.0"
