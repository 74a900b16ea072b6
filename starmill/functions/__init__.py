"""Column builders.  All of them stay inside JVM expressions; none is a UDF."""
