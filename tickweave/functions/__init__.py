"""Column functions; everything here stays in the JVM."""
