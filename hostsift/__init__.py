"""hostsift: host-list analytics expressed as lazy PySpark DataFrame operators."""
