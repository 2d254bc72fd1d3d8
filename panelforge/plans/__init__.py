"""Plans: logical views over the driver tables, declarative derive specs, registered queries."""
