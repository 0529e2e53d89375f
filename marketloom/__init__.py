"""marketloom: marketplace analytics as lazy PySpark DataFrame functions.

Raw marketplace tables -> typed staging -> star schema -> KPI marts, with keyed
incremental merges, a declarative data-quality suite and report aggregates.
"""
