"""textstyle: telling machine-written from human-written text, as Spark jobs."""
