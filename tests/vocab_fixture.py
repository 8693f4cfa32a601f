"""Synthetic vocabulary folder in the export dialect (tab, backspace quote)."""
import os

CLEAN = {
    "DOMAIN.csv": ["DOMAIN_ID\tDOMAIN_NAME\tDOMAIN_CONCEPT_ID",
                   "Metadata\tMetadata\t1", "Drug\tDrug\t1"],
    "VOCABULARY.csv": ["vocabulary_name\tvocabulary_id\tvocabulary_concept_id\tvocabulary_reference\tvocabulary_version",
                       "Vocabulary\tVocabulary\t2\t\tv5"],
    "CONCEPT_CLASS.csv": ["concept_class_id\tconcept_class_name\tconcept_class_concept_id",
                          "Domain\tDomain\t3", "Ingredient\tIngredient\t3", "Vocabulary\tVocabulary\t3"],
    "RELATIONSHIP.csv": ["relationship_id\trelationship_name\tis_hierarchical\tdefines_ancestry\t"
                         "reverse_relationship_id\trelationship_concept_id",
                         "Is a\tIs a\t1\t1\tSubsumes\t4", "Subsumes\tSubsumes\t1\t0\tIs a\t4"],
    "CONCEPT.csv": ["concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\t"
                    "concept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason",
                    "1\tMetadata domain\tMetadata\tVocabulary\tDomain\t\tMD\t19700101\t20991231\t",
                    "2\tVocabulary vocabulary\tMetadata\tVocabulary\tDomain\t\tV\t1970-01-01\t2099-12-31\t",
                    "3\tClass class\tMetadata\tVocabulary\tDomain\t\tC\t19700101\t20991231\t",
                    "4\tRelationship\tMetadata\tVocabulary\tDomain\t\tR\t19700101\t20991231\t",
                    '10\tAspirin "brand" name\tDrug\tVocabulary\tIngredient\tS\tA1\t19700101\t20991231\t',
                    '11\tHe said "hi\tDrug\tVocabulary\tIngredient\tS\tA2\t19700101\t20991231\t',
                    "12\tback\\slash\tDrug\tVocabulary\tIngredient\t\tA3\t19700101\t20991231\t",
                    "13\t  padded  \tDrug\tVocabulary\tIngredient\t\tA4\t19700101\t20991231\tD",
                    "20\tmg\tDrug\tVocabulary\tIngredient\t\tU1\t19700101\t20991231\t"],
    "CONCEPT_RELATIONSHIP.csv": ["concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\tinvalid_reason",
                                 "10\t11\tIs a\t19700101\t20991231\t"],
    "CONCEPT_ANCESTOR.csv": ["ancestor_concept_id\tdescendant_concept_id\tmin_levels_of_separation\tmax_levels_of_separation",
                             "11\t10\t1\t1", "11\t11\t0\t0", "10\t10\t0\t0"],
    "CONCEPT_SYNONYM.csv": ["concept_id\tconcept_synonym_name\tlanguage_concept_id", "10\tASA\t1"],
    "DRUG_STRENGTH.csv": ["drug_concept_id\tingredient_concept_id\tamount_value\tamount_unit_concept_id\t"
                          "numerator_value\tnumerator_unit_concept_id\tdenominator_value\tdenominator_unit_concept_id\t"
                          "box_size\tvalid_start_date\tvalid_end_date\tinvalid_reason",
                          "10\t10\t5.5\t20\t\t\t\t\t\t19700101\t20991231\t"],
}


def write_vocab(folder, overrides=None, drop=()):
    os.makedirs(folder, exist_ok=True)
    files = dict(CLEAN)
    files.update(overrides or {})
    for name, lines in files.items():
        if name in drop:
            continue
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    return folder
