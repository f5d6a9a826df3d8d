"""siltworks: characterisation of large harvested document collections on Spark.

Everything is expressed as DataFrame transformations. Sub-packages:

* ``sources``    readers and writers
* ``functions``  column expressions (URL, text, XML, geometry, rules, ...)
* ``operators``  DataFrame -> DataFrame operators
* ``plans``      the registered queries and their SQL counterparts
* ``streaming``  the same transformations over unbounded inputs
* ``llm``        training-text operators; optional, nothing else imports it
"""

__version__ = "0.1.0"
