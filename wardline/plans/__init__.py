"""Query plans: bindings of the driver's test tables to clinical roles and the
registered queries built from the operators."""
