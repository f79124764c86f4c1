"""Operations KPIs as Spark DataFrame jobs: operators, and the measures composed from them."""
